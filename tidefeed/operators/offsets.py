"""The position of a feed as the map that a checkpoint stores, and how it moves."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys of the stored map.
SEQUENCE, TIME, RECEIVER, PROCESSED, LIBRARY, TABLES, COMPLETE = "event_sequence", "time", "receiver", "processed", "receiver_library", "table.include.list", "snapshot_completed"
NONE = "null"


@dataclass(frozen=True)
class FeedOffset:
    """Where a feed is; ``seq`` of None: nowhere yet. Times are seconds since 1970, 0 if unknown."""

    seq: int | None = None
    receiver: str = ""
    library: str = ""
    time: int = 0
    processed: bool = False
    tables: str = ""
    complete: bool = False

    @property
    def blank(self) -> bool:
        return self.seq is None

    def store(self) -> dict[str, str]:
        flag = lambda x: str(x).lower()
        return {SEQUENCE: NONE if self.seq is None else str(self.seq), TIME: str(self.time), RECEIVER: self.receiver, PROCESSED: flag(self.processed), LIBRARY: self.library, TABLES: self.tables, COMPLETE: flag(self.complete)}

    @classmethod
    def load(cls, stored: Mapping[str, str | None]) -> FeedOffset:
        """From a stored map; a sequence that is missing, blank or "null" is the blank position, which has no segment."""
        flag = lambda k: (stored.get(k) or "").lower() == "true"
        kept = cls(tables=stored.get(TABLES) or "", complete=flag(COMPLETE))
        text = (stored.get(SEQUENCE) or "").strip()
        if text in ("", NONE):
            return kept
        return replace(kept, seq=int(text), receiver=stored.get(RECEIVER) or "", library=stored.get(LIBRARY) or "", time=int(stored.get(TIME) or 0), processed=flag(PROCESSED))

    def moved(self, seq: int, receiver: str, processed: bool, time: int = 0, library: str | None = None) -> FeedOffset:
        """At another entry; an entry without a time leaves the time as it is."""
        return replace(self, seq=seq, receiver=receiver, processed=processed, time=time or self.time, library=self.library if library is None else library)

    def same_place(self, other: FeedOffset) -> bool:
        """Whether both are at one entry; their times don't count."""
        return (self.seq, self.receiver, self.library, self.processed) == (other.seq, other.receiver, other.library, other.processed)


def added_tables(old: str | None, new: str | None) -> list[str]:
    """Tables of the new include list that the old one hasn't; none if either is unknown."""
    if old is None or new is None:
        return []
    listed = lambda text: [x.strip() for x in text.split(",") if x.strip()]
    return [x for x in dict.fromkeys(listed(new)) if x not in listed(old)]


def snapshot_offset(stored: FeedOffset, end: FeedOffset, added: list[str]) -> tuple[FeedOffset, FeedOffset]:
    """(where tables that were there go on, where tables that are snapshot now begin): the journal's end for the latter.

    A feed without a position starts at the end; one with a position keeps it, so that adding tables skips nothing.
    """
    cut = replace(end, processed=True)
    return (cut if stored.blank or not stored.complete else stored), (cut if added or stored.blank or not stored.complete else stored)


def stored_map(seq: Column, time: Column, receiver: Column, processed: Column) -> Column:
    """The stored map of a position in columns, as JSON; a null sequence is "null"."""
    return F.to_json(F.struct(F.coalesce(seq.cast("string"), F.lit(NONE)).alias(SEQUENCE), F.coalesce(F.unix_timestamp(time.cast("timestamp")), F.lit(0)).cast("string").alias(TIME), F.coalesce(receiver.cast("string"), F.lit("")).alias(RECEIVER), processed.cast("string").alias(PROCESSED)))


def loaded(rows: DataFrame, column: str = "stored") -> DataFrame:
    """``rows`` with ``seq``, ``receiver``, ``time`` and ``processed`` of a stored map; nulls for the blank position."""
    kept = rows.withColumn("_map", F.from_json(column, "map<string,string>"))
    at = F.col("_map")
    fine = F.coalesce(at[SEQUENCE], F.lit(NONE)).rlike("^[0-9]+$")
    return kept.withColumns({
        "seq": F.when(fine, at[SEQUENCE].cast("decimal(20,0)")), "receiver": F.when(fine, at[RECEIVER]), "time": F.when(fine, at[TIME].cast("long")), "processed": F.when(fine, at[PROCESSED] == "true").otherwise(F.lit(False)),
    }).drop("_map")


def resumed(entries: DataFrame, keys: tuple[str, ...] = ("rcv", "rseq")) -> DataFrame:
    """Entries of overlapping deliveries, each once. Numbers restart by segment, so an entry is known by both."""
    return entries.dropDuplicates(list(keys))


def after(entries: DataFrame, seq: int, receiver: int, processed: bool) -> DataFrame:
    """Entries from a position in ``(rcv, rseq)`` on: its own entry only if that isn't done, later segments whole."""
    rcv, own = F.col("rcv"), F.col("rseq")
    return entries.where((rcv > receiver) | ((rcv == receiver) & ((own > seq) if processed else (own >= seq))))
