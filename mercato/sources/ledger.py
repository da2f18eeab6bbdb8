"""Control totals taken while a table is written, and their balance from step to step.

A write of ``Ledger`` observes the rows that enter it, those that each rule
keeps out and those that leave it: row counts, money sums, NULL keys and
negative amounts. No table is read a second time for its checks. The totals
come from the writing stage itself (a shuffle after an observation could count a
repeated task twice), so ``rules`` belong after the last join or grouping.

``Ledger.balance`` raises unless, for every table and total, what entered is
what left plus what was kept out, and what entered is what its source's write
put out. A table without rules has only the totals of what left it.

Defined results: an empty table has 0 rows and sums of 0; a NULL condition of a
rule does not hold; a row goes to the first rule that holds; NULL amounts count
as 0; working columns have names of their own, so that others never clash.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .sinks import write_table

COLUMNS = "table_name string, flow string, rule string, total string, value decimal(28,2)"


class LedgerError(ValueError):
    pass


@dataclass(frozen=True)
class Totals:
    """What is counted of a table besides its rows: sums of amounts, NULLs of keys, negative amounts."""
    sums: Sequence[str] = ()
    keys: Sequence[str] = ()
    not_negative: Sequence[str] = ()

    def expressions(self, only: Column) -> dict[str, Column]:
        """Aggregates over the rows where ``only`` holds."""
        return {"rows": F.count_if(only),
                **{f"sum {c}": F.coalesce(F.sum(F.when(only, F.col(c))), F.lit(0)) for c in self.sums},
                **{f"null {c}": F.count_if(only & F.col(c).isNull()) for c in self.keys},
                **{f"negative {c}": F.count_if(only & F.coalesce(F.col(c) < 0, F.lit(False))) for c in self.not_negative}}


def _observed(df: DataFrame, groups: Mapping[tuple[str, str], Column], totals: Totals) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """``df`` observed for each (flow, rule) and the function that gives the (flow, rule, total, value) after the write."""
    names, columns = [], []
    for (flow, rule), only in groups.items():
        for total, value in totals.expressions(only).items():
            names.append((flow, rule, total))
            columns.append(value.cast("decimal(28,2)").alias(f"v{len(columns)}"))
    seen = Observation(f"ledger_{uuid.uuid4().hex}")
    return df.observe(seen, *columns), lambda: [(*n, seen.get[f"v{k}"]) for k, n in enumerate(names)]


@dataclass
class Ledger:
    """Totals of the writes of one run: (table, flow, rule, total, value), flow being in, kept out or out."""
    entries: list[tuple[str, str, str, str, Decimal]] = field(default_factory=list)
    _lock: Lock = field(default_factory=Lock, repr=False)

    def write(self, df: DataFrame, path: str, name: str, totals: Totals = Totals(), rules: Mapping[str, Column] | None = None,
              finish: Callable[[DataFrame], DataFrame] = lambda df: df, **kw) -> int:
        """Writes the rows of ``df`` that no rule keeps out, after ``finish`` (row by row), and returns their number."""
        found = []
        if rules:
            mark = f"rule_{uuid.uuid4().hex}"
            choice = F.lit(None).cast("string")
            for rule, holds in reversed(list(rules.items())):
                choice = F.when(holds, F.lit(rule)).otherwise(choice)
            groups = {("in", ""): F.lit(True), **{("kept out", r): F.col(mark).eqNullSafe(r) for r in rules}}
            seen, read = _observed(df.withColumn(mark, choice), groups, totals)
            found.append(read)
            df = seen.where(F.col(mark).isNull()).drop(mark)
        out, read = _observed(finish(df), {("out", ""): F.lit(True)}, totals)
        found.append(read)
        write_table(out, path, **kw)
        rows = [(name, *r) for read in found for r in read()]
        with self._lock:
            self.entries += rows
        return int(self.value(name, "out", "rows"))

    def value(self, name: str, flow: str, total: str, rule: str = "") -> Decimal:
        return next(v for n, f, r, t, v in self.entries if (n, f, r, t) == (name, flow, rule, total))

    def _of(self, name: str, flow: str) -> dict[str, Decimal]:
        sums: dict[str, Decimal] = {}
        for n, f, _, t, v in self.entries:
            if (n, f) == (name, flow):
                sums[t] = sums.get(t, Decimal(0)) + v
        return sums

    def balance(self, sources: Mapping[str, str] = {}) -> None:
        """Raises naming every total that does not balance; ``sources``: table -> table of the ledger that it was made of."""
        off = []
        for name in dict.fromkeys(e[0] for e in self.entries):
            came, out, kept_out = (self._of(name, f) for f in ("in", "out", "kept out"))
            off += [f"{name}: {t}: {v} in, {out[t]} out, {kept_out.get(t, 0)} kept out"
                    for t, v in came.items() if v != out[t] + kept_out.get(t, 0)]
            before = self._of(sources[name], "out") if name in sources else {}
            off += [f"{name}: {t}: {v} in, {before[t]} out of {sources[name]}" for t, v in came.items() if t in before and v != before[t]]
        if off:
            raise LedgerError("Control totals do not balance:\n" + "\n".join(off))

    def checks(self, filled: Sequence[str]) -> list[tuple[str, int, bool]]:
        """(check, value, passed): the tables of ``filled`` have rows; what left a table has no NULL key or negative amount."""
        rows = [(f"{n} rows", int(v := self.value(n, "out", "rows")), v > 0) for n in filled]
        return rows + [(f"{n} {t}", int(v), v == 0) for n, f, _, t, v in self.entries
                       if f == "out" and t.startswith(("null ", "negative "))]

    def frame(self, spark: SparkSession) -> DataFrame:
        """The ledger as rows: a few for each written table."""
        return spark.createDataFrame(self.entries, COLUMNS)
