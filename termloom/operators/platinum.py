"""Per-agreement constraint sets over active gold rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Parts that keys are spread over where a row fits all of them.
SALTS = 16


def agreement_keys(terms: DataFrame, limits: DataFrame, margins: DataFrame) -> DataFrame:
    """(counterparty, agreement_id) that terms, margins, or limits with a counterparty name; where there is none but limits, one of nulls."""
    keys = terms.select("counterparty", "agreement_id").unionByName(margins.select("counterparty", "agreement_id")).unionByName(limits.where(F.col("counterparty").isNotNull()).select("counterparty", "agreement_id"))
    return keys.distinct()


def _pattern(name: str, counterparty: Column, agreement: Column, salt: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(name).alias("p"), F.coalesce(counterparty, none).alias("c"), F.coalesce(agreement, none).alias("a"), salt.cast("int").alias("s"))


def wildcard_join(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """Keys with the rows that fit them: by ``exact`` rows both parts are equal (null to null), by others each part is equal or null in the row.

    A condition with OR would compare all with all. Here a row has the pattern of its nulls,
    a key has one row for each pattern, and one equi-join on pattern and values does it, so keys
    and rows are made once. Rows without either part fit every key: each is copied to every
    salt, and keys are spread over the salts.
    """
    c, a, none = F.col("counterparty"), F.col("agreement_id"), F.lit(None).cast("string")
    own = F.pmod(F.xxhash64("counterparty", "agreement_id"), F.lit(SALTS))
    zero = F.lit(0)
    asked = F.array(_pattern("exact", c, a, zero), _pattern("both", c, a, zero), _pattern("counterparty", c, none, zero), _pattern("agreement", none, a, zero), _pattern("any", none, none, own))
    wanted = keys.select("counterparty", "agreement_id", F.explode(asked).alias("k"))
    name = F.when(F.col("exact"), "exact").when(c.isNotNull() & a.isNotNull(), "both").when(c.isNotNull(), "counterparty").when(a.isNotNull(), "agreement").otherwise("any")
    salts = F.when(name == "any", F.sequence(zero, F.lit(SALTS - 1))).otherwise(F.array(zero))
    held = rows.withColumn("p", name).withColumn("s", F.explode(salts)).withColumnsRenamed({"counterparty": "_c", "agreement_id": "_a"})
    fits = (F.col("k.p") == F.col("p")) & (F.col("k.s") == F.col("s")) & F.col("k.c").eqNullSafe(F.col("_c")) & F.col("k.a").eqNullSafe(F.col("_a"))
    return wanted.join(held, fits).drop("k", "p", "s", "_c", "_a", "exact")


def ordered(sets: DataFrame) -> DataFrame:
    """Constraint sets by counterparty and agreement, missing ones as empty texts."""
    return sets.orderBy(F.coalesce("counterparty", F.lit("")), F.coalesce("agreement_id", F.lit("")))


def constraint_sets(terms: DataFrame, limits: DataFrame, margins: DataFrame) -> DataFrame:
    """Long form: counterparty, agreement_id, kind, member of each set."""
    rows = [(terms, "term", True), (limits, "limit", False), (margins.where(F.col("counterparty").isNotNull()), "margin", False)]
    told = [df.select("counterparty", "agreement_id", F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("member"), F.lit(exact).alias("exact")) for df, kind, exact in rows]
    return wildcard_join(agreement_keys(terms, limits, margins), told[0].unionByName(told[1]).unionByName(told[2])).select("counterparty", "agreement_id", "kind", "member")
