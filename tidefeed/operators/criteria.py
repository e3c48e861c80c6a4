"""What a read of the journal asks for, as a predicate that reaches the scan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidefeed.operators.receivers import chain_numbers, last_joined


class InvalidFilter(Exception):
    """The journal refuses the filter; reading on makes no sense."""


# Journal codes, entry types, special values.
CODES = tuple("ABCDEFIJLMPQRSTU")
TYPES = ("BR", "DL", "DR", "IL", "PT", "PX", "UB", "UP", "UR", "CT", "CG", "SC", "CM")
FIRST, LAST, ALL = "*FIRST", "*LAST", "*ALL"
CURRENT, CURRENT_CHAIN, AVAILABLE_CHAIN = "*CURRENT", "*CURCHAIN", "*CURAVLCHN"
#: The widths that null indicators may be asked for in: this or a multiple of it.
INDICATOR_STEP = 16


@dataclass(frozen=True)
class Criteria:
    """All that is given must hold. ``receivers``: a special value, or the first and the last segment."""

    receivers: str | tuple[int, int] = ""
    start: int | str = FIRST
    end: int | str = LAST
    most: int | None = None
    codes: tuple[str, ...] = ()
    types: tuple[str, ...] = (ALL,)
    files: tuple[Any, ...] = ()
    since: str | None = None
    until: str | None = None
    users: tuple[int, ...] = ()
    cycles: tuple[int, ...] = ()
    indicator_length: int | None = None

    def __post_init__(self) -> None:
        if isinstance(self.receivers, str) and self.receivers not in ("", CURRENT, CURRENT_CHAIN, AVAILABLE_CHAIN):
            raise InvalidFilter(f"receiver range {self.receivers}")
        if unknown := [c for c in self.codes if c not in CODES] + [t for t in self.types if t not in (*TYPES, ALL)]:
            raise InvalidFilter(f"unknown codes or types {unknown}")
        if (isinstance(self.start, str) and self.start != FIRST) or (isinstance(self.end, str) and self.end != LAST):
            raise InvalidFilter(f"range {self.start} to {self.end}")
        if self.most is not None and self.most < 1:
            raise InvalidFilter(f"{self.most} entries")
        if self.indicator_length is not None and (self.indicator_length <= 0 or self.indicator_length % INDICATOR_STEP):
            raise InvalidFilter(f"null indicators of {self.indicator_length} bytes")

    def with_(self, **given: Any) -> Criteria:
        return replace(self, **given)

    @classmethod
    def from_options(cls, options: Mapping[str, str]) -> Criteria:
        """From the string options of a source: ``codes=R,C``, ``types``, ``files``, ``users``, ``start``, ``end``, ``most``, ``since``, ``until``, ``receivers=2:4``."""
        listed = lambda k, kind=str: tuple(kind(x.strip()) for x in options.get(k, "").split(",") if x.strip())
        number = lambda k, special: special if options.get(k, special) == special else int(options[k])
        given: dict[str, Any] = {"codes": listed("codes"), "types": listed("types") or (ALL,), "files": listed("files", int), "users": listed("users", int), "cycles": listed("cycles", int)}
        given |= {"start": number("start", FIRST), "end": number("end", LAST), "since": options.get("since"), "until": options.get("until")}
        given["most"] = int(options["most"]) if options.get("most") else None
        receivers = options.get("receivers", "")
        given["receivers"] = tuple(map(int, receivers.split(":"))) if ":" in receivers else receivers
        return cls(**given)

    def predicate(self) -> Column:
        """What holds for an entry by itself. Commit entries concern no table, so ``files`` lets them through."""
        seq, code = F.col("seq"), F.col("code")
        tests: list[Column] = []
        if not isinstance(self.start, str):
            tests.append(seq >= self.start)
        if not isinstance(self.end, str):
            tests.append(seq <= self.end)
        if self.codes:
            tests.append(reduce(Column.__or__, [code.startswith(f"{c}.") for c in self.codes]))
        if ALL not in self.types:
            tests.append(reduce(Column.__or__, [code.endswith(f".{t}") for t in self.types]))
        if self.files:
            tests.append(F.col("file_no").isin(*self.files))
        if self.since:
            tests.append(F.col("ts") >= F.lit(self.since).cast("timestamp_ntz"))
        if self.until:
            tests.append(F.col("ts") <= F.lit(self.until).cast("timestamp_ntz"))
        if self.users:
            tests.append(F.col("user_id").isin(*self.users))
        if self.cycles:
            tests.append(F.col("cycle").isin(*self.cycles))
        if isinstance(self.receivers, tuple):
            tests.append(F.col("rcv").between(*self.receivers))
        return reduce(Column.__and__, tests, F.lit(True))

    def wants(self, entry: Mapping[str, Any]) -> bool:
        """The same for an entry at hand, of what it says."""
        code = str(entry.get("code") or "")
        letter, _, kind = code.partition(".")
        return (
            (isinstance(self.start, str) or entry["seq"] >= self.start) and (isinstance(self.end, str) or entry["seq"] <= self.end)
            and (not self.codes or letter in self.codes) and (ALL in self.types or kind in self.types) and (not self.files or entry.get("file_no") in self.files)
            and (not self.users or entry.get("user_id") in self.users) and (not self.cycles or entry.get("cycle") in self.cycles)
        )

    def apply(self, entries: DataFrame, receivers: DataFrame | None = None) -> DataFrame:
        """The entries that are asked for. Special receiver ranges need the segments; ``most`` takes the first by number."""
        out = entries.where(self.predicate())
        if isinstance(self.receivers, str) and self.receivers:
            if receivers is None:
                raise InvalidFilter("a special receiver range needs the segments")
            out = out.join(self._segments(receivers), "rcv", "left_semi")
        return out.orderBy("seq").limit(self.most) if self.most else out

    def _segments(self, receivers: DataFrame) -> DataFrame:
        attached = receivers.where("status = 1").select("rcv")
        if self.receivers == CURRENT:
            return attached
        if self.receivers == AVAILABLE_CHAIN:
            return last_joined(receivers).select("rcv")
        chains = chain_numbers(receivers)
        return chains.join(chains.join(attached, "rcv").select("chain"), "chain", "left_semi").select("rcv")
