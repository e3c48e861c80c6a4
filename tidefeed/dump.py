"""Prints what a journal holds: ``python -m tidefeed.dump FOLDER [option=value ...]``, with the options of the journal source.

A line for each entry: its segment, number, code, and the rest as JSON. Lines that can't be read
are shown as they are, behind a question mark.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

from tidefeed.operators.criteria import Criteria
from tidefeed.operators.feed import KINDS
from tidefeed.sources.segments import Folder, lines_between


def entries(folder: str, options: dict[str, str]) -> Iterator[str]:
    criteria, found = Criteria.from_options(options), Folder.of(folder)
    for s in found.segments():
        for number, entry, line in lines_between(str(found.path / s.name), s.first, s.last):
            if entry is None:
                yield f"{s.name} ? {line.decode('utf-8', 'replace')}"
            elif criteria.wants(entry):
                rest = {k: v for k, v in entry.items() if k not in ("seq", "code")}
                yield f"{s.name} {number} {entry.get('code')} {KINDS.get(entry.get('code'), '-')} {json.dumps(rest)}"


def main(arguments: list[str]) -> None:
    for line in entries(arguments[0], dict(a.split("=", 1) for a in arguments[1:])):
        print(line)


if __name__ == "__main__":
    main(sys.argv[1:])
