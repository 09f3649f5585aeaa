"""Declared rules applied to a batch: every row gets the first rule that it breaks.

The same declarations (:data:`voltaic.schemas.RULES`) that the quality checks report on are
enforced here, before a load writes anything: NOT NULL, length, precision, domain, foreign
key and the declared time range.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import TableRules
from .joins import sized_broadcast

REJECT = "_reject"


def broken_rule(df: DataFrame, rules: TableRules) -> Column:
    """Name of the first rule, of those that one row decides, that a row breaks; else NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}
    found = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in rules.not_null if c in types]
    found += [F.when(F.length(F.col(c)) > n, F.lit(f"too long {c}")) for c, n in rules.max_length.items() if c in types]
    for c, (p, s) in rules.decimals.items():
        if c in types and not (isinstance(types[c], T.DecimalType) and types[c].precision <= p and types[c].scale <= s):
            found.append(F.when(F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull(), F.lit(f"out of range {c}")))
    found += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(*vals), F.lit(f"not in domain {c}"))
              for c, vals in rules.domains.items() if c in types]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def with_rejects(df: DataFrame, rules: TableRules | None = None, keys=(), ts: str | None = None,
                 references: dict[str, DataFrame] | None = None, bounds: tuple | None = None) -> DataFrame:
    """``df`` with ``_reject``: an earlier reason (as from a CSV scan), else ``missing <key>``,
    else the first broken rule, else ``outside the range <ts>`` (lo <= ts < hi; an end that is None
    is open), else ``no such <column>`` for
    a foreign key that the referenced table (``references``: column -> frame whose first
    column holds the keys) does not have.  NULL foreign keys are not looked up."""
    d = df if REJECT in df.columns else df.withColumn(REJECT, F.lit(None).cast("string"))
    need = list(dict.fromkeys([*keys, *([ts] if ts else [])]))
    reasons = [F.col(REJECT)] + [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in need]
    if rules is not None:
        reasons.append(broken_rule(df, rules))
    if bounds is not None and ts:
        at = lambda x: F.lit(x).cast(df.schema[ts].dataType)
        lo, hi = bounds
        outside = [F.col(ts) < at(lo)] * (lo is not None) + [F.col(ts) >= at(hi)] * (hi is not None)
        reasons += [F.when(o, F.lit(f"outside the range {ts}")) for o in outside]
    d = d.withColumn(REJECT, F.coalesce(*reasons))
    for c, table in (references or {}).items():
        known = sized_broadcast(table.select(F.col(table.columns[0]).alias(c)).where(F.col(c).isNotNull()).distinct()
                                .withColumn("_known", F.lit(True)))
        d = d.join(known, c, "left").withColumn(REJECT, F.coalesce(
            F.col(REJECT), F.when(F.col(c).isNotNull() & F.col("_known").isNull(), F.lit(f"no such {c}")))).drop("_known")
    return d.select(*reduce(lambda a, c: a + [c] if c not in a else a, [*df.columns, REJECT], []))
