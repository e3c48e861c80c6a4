import pytest

from tidefeed.operators.ranges import Position, Segment, in_segment, next_range, refreshed

T3 = [("j1", 1, 10), ("j2", 11, 20), ("j3", 21, 30)]
#: segments, start, most, end (and start if it moves)
CASES = [
    ([("j1", 1, 2)], (1, "j1", True), 100, (2, "j1"), None),
    ([("j1", 1, 2), ("j2", 3, 8)], (1, "j1", True), 100, (8, "j2"), None),
    ([("j1", 1, 5), ("j2", 6, 20), ("j3", 21, 22)], (1, "j1", True), 3, (4, "j1"), None),
    (T3, (1, "j1", True), 15, (16, "j2"), None),
    ([("j1", 1, 2), ("j2", 3, 20), ("j3", 21, 22)], (1, "j1", True), 10, (11, "j2"), None),
    ([("j1", 1, 2), ("j2", 3, 20), ("j3", 21, 35)], (1, "j1", True), 30, (31, "j3"), None),
    ([("j1", 1, 2), ("j2", 3, 20), ("j3", 21, 35)], (1, "j1", True), 100, (35, "j3"), None),
    ([("j1", 1, 10)], (1, "j1", True), 100, (10, "j1"), None),
    ([*T3, ("j4", 41, 50)], (25, "j3", True), 10, (45, "j4"), None),
    ([("j1", 1, 10)], (10, "j1", False), 15, (10, "j1"), None),
    ([("j1", 1, 10)], (10, "j1", True), 15, (10, "j1"), None),
    ([("j1", 1, 10), ("j2", 1, 1)], (10, "j1", True), 20, (1, "j2"), (1, "j2", False)),
    ([("j1", 1, 10), ("j2", 1, 1)], (10, "j1", False), 20, (10, "j1"), None),
    ([("j1", 1, 10), ("j2", 1, 10)], (10, "j1", True), 5, (5, "j2"), (1, "j2", False)),
    ([("a", 1, 10), ("b", 1, 5)], (1, "a", True), 10, (10, "a"), None),
]


@pytest.mark.parametrize(("segments", "start", "most", "end", "moved"), CASES)
def test_next_range(segments, start, most, end, moved):
    found = next_range([Segment(*s) for s in segments], Position(*start), most)
    assert (found.end.offset, found.end.segment) == end
    assert found.start == Position(*(moved or start))


def test_empty_range_only_if_processed():
    segments = [Segment("j1", 1, 10)]
    assert next_range(segments, Position(10, "j1", True), 15).empty
    assert not next_range(segments, Position(10, "j1", False), 15).empty


def test_unknown_start_and_one_segment():
    assert next_range([Segment("j1", 1, 10), Segment("j2", 11, 20)], Position(30, "j3"), 15) is None
    assert in_segment(Position(1, "j1"), Position(100, "j1"), 10).end.offset == 11
    assert in_segment(Position(1, "j1"), Position(100, "j1"), 1000).end.offset == 100
    with pytest.raises(ValueError):
        in_segment(Position(1, "j1"), Position(1, "j2"), 5)


def test_refreshed():
    known = [Segment("j1", 1, 10), Segment("j2", 11, 20)]
    assert refreshed(known, Segment("j2", 11, 200))[1].last == 200
    assert len(refreshed(known, Segment("j3", 21, 22))) == 3
