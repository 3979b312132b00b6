"""Decision tables as data: versioned, compiled to one expression, with a report of rules that decide nothing.

A table is a name, a version and rows of (label, condition text). Its rows can
be read, compared between versions and tested; nothing else holds the logic.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import first_match


@dataclass(frozen=True)
class DecisionTable:
    """Rows in order of precedence; a condition that is NULL does not hold."""

    name: str
    version: str
    rows: tuple[tuple[str, str], ...]
    default: str | None = None

    def __post_init__(self):
        if not self.rows:
            raise ValueError(f"{self.name} {self.version} has no rows")
        if len({(label, condition) for label, condition in self.rows}) < len(self.rows):
            raise ValueError(f"{self.name} {self.version} repeats a row")

    @property
    def labels(self) -> list[str]:
        """Every label the table can give, in order, each once."""
        return list(dict.fromkeys([label for label, _ in self.rows] + ([self.default] if self.default is not None else [])))

    def conditions(self) -> list[Column]:
        return [F.coalesce(F.expr(condition), F.lit(False)) for _, condition in self.rows]

    def decide(self) -> Column:
        """Label of the first row that holds, else the default."""
        return first_match(list(zip(self.conditions(), [label for label, _ in self.rows])), self.default)

    def texts(self, sep: str = ", ") -> Column:
        """Labels of all rows that hold, joined in order; empty text if none."""
        return F.concat_ws(sep, *[F.when(test, F.lit(label)) for test, (label, _) in zip(self.conditions(), self.rows)])

    def coverage(self, df: DataFrame) -> DataFrame:
        """One row per rule: (name, version, position, label, held, decided, verdict), the default last.

        ``held`` counts the rows for which the condition holds, ``decided`` those
        for which it is the first. The verdict is ``decides``, ``never reached``
        (the condition never holds) or ``always covered`` (earlier rules take
        every row). One pass and one aggregate row, whatever the input.
        """
        tests = self.conditions()
        first = first_match([(test, i) for i, test in enumerate(tests)], len(tests))
        marked = df.select(F.array(*tests).alias("held"), first.alias("first"))
        counts = [F.count_if(F.col("held")[i]) for i in range(len(tests))] + [F.count(F.lit(1))]
        firsts = [F.count_if(F.col("first") == i) for i in range(len(tests) + 1)]
        labels = [*[label for label, _ in self.rows], self.default]
        rules = F.array(
            *[F.struct(F.lit(i + 1).alias("position"), F.lit(label).cast("string").alias("label"), held.alias("held"), decided.alias("decided")) for i, (label, held, decided) in enumerate(zip(labels, counts, firsts))]
        )
        verdict = F.when(F.col("decided") > 0, "decides").when(F.col("held") == 0, "never reached").otherwise("always covered")
        report = marked.agg(rules.alias("rules")).select(F.inline("rules"))
        return report.select(F.lit(self.name).alias("name"), F.lit(self.version).alias("version"), "*", verdict.alias("verdict"))


def changes(old: DecisionTable, new: DecisionTable) -> list[tuple[str, str, str | None, str | None]]:
    """(change, label, old condition, new condition) between two versions: added, removed, changed or moved rows."""
    before, after = (_by_label(t) for t in (old, new))
    common = [label for label in before if label in after]
    order = [label for label in after if label in before]
    out = [("removed", label, before[label], None) for label in before if label not in after]
    out += [("added", label, None, after[label]) for label in after if label not in before]
    out += [("changed", label, before[label], after[label]) for label in common if before[label] != after[label]]
    return out + [("moved", label, before[label], after[label]) for label, at in zip(common, order) if label != at]


def _by_label(table: DecisionTable) -> dict[str, str]:
    out: dict[str, str] = {}
    for label, condition in table.rows:
        out[label] = f"{out[label]} OR {condition}" if label in out else condition
    return out


def any_of(columns: Sequence[str], value: int = 1) -> str:
    """Condition text: one of the flags has the value."""
    return "(" + " OR ".join(f"{c} = {value}" for c in columns) + ")"


def all_of(columns: Sequence[str], value: int = 0) -> str:
    """Condition text: all flags have the value."""
    return "(" + " AND ".join(f"{c} = {value}" for c in columns) + ")"


def listed(column: str, values: Sequence[str]) -> str:
    """Condition text: the column has one of the values."""
    return f"{column} IN (" + ", ".join(f"'{v}'" for v in values) + ")"
