"""Declarative data-quality checks: not_null, unique, relationships and
accepted_values, reported as ``(model, column, test, failures)``.

Failure counts follow the usual meaning of these column tests:

* not_null -- rows where the column is null;
* unique -- distinct non-null values that occur more than once;
* relationships -- child rows with a non-null value missing from the parent;
* accepted_values -- distinct non-null values outside the accepted list.

Nulls are counted in place: no value is shuffled for them.  The other checks of
a model share one aggregation of ``(column, fingerprint)`` pairs, with partial
aggregation collapsing hot values before the shuffle.  A fingerprint is 16
bytes, two 64-bit hashes of the value's text, so no text is shuffled; two
different values share one with a probability of about 1e-15 among 10**12.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NOT_NULL = "not_null"
UNIQUE = "unique"
RELATIONSHIPS = "relationships"
ACCEPTED_VALUES = "accepted_values"
KINDS = (NOT_NULL, UNIQUE, RELATIONSHIPS, ACCEPTED_VALUES)


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    test: str
    to: str | None = None          # parent model of a relationships check
    field: str | None = None       # parent column of a relationships check
    values: tuple = ()


def _nn(model, column):
    return Check(model, column, NOT_NULL)


def _uq(model, column):
    return Check(model, column, UNIQUE)


def _rel(model, column, to, fld):
    return Check(model, column, RELATIONSHIPS, to, fld)


def _dim_checks(dim: str, key: str) -> list[Check]:
    return [_uq(dim, key), _nn(dim, key), _uq(dim, "user_id"), _nn(dim, "user_id"),
            _rel(dim, "user_id", "stg_classified_movie_review", "user_id")]


# The declared suite, in declaration order (sources, staging,
# dims, fact).  Model names are the corrected ones (dim_devices; the fact's
# second device-key entry is the os key).
DECLARED_SUITE: tuple[Check, ...] = tuple([
    _nn("user_purchase", "invoice_number"),
    _nn("user_purchase", "stock_code"),
    _uq("classified_movie_review", "review_id"),
    _nn("classified_movie_review", "review_id"),
    _uq("review_logs", "log_id"),
    _nn("review_logs", "log_id"),
    _uq("stg_review_logs", "log_id"),
    _nn("stg_review_logs", "log_id"),
    _uq("stg_classified_movie_review", "user_id"),
    _nn("stg_classified_movie_review", "user_id"),
    _rel("stg_classified_movie_review", "user_id", "stg_user_purchase", "customer_id"),
    Check("stg_classified_movie_review", "positive_review", ACCEPTED_VALUES, values=(0, 1)),
    _nn("stg_user_purchase", "invoice_number"),
    _nn("stg_user_purchase", "stock_code"),
    _nn("stg_user_purchase", "customer_id"),
    *_dim_checks("dim_date", "id_dim_date"),
    *_dim_checks("dim_devices", "id_dim_devices"),
    *_dim_checks("dim_ip", "id_dim_ip"),
    *_dim_checks("dim_location", "id_dim_location"),
    *_dim_checks("dim_os", "id_dim_os"),
    *_dim_checks("dim_phone_number", "id_dim_phone_number"),
    _uq("fact_movie_analytics", "fact_key"),
    _nn("fact_movie_analytics", "fact_key"),
    _uq("fact_movie_analytics", "id_dim_devices"),
    _nn("fact_movie_analytics", "id_dim_devices"),
    _uq("fact_movie_analytics", "id_dim_location"),
    _nn("fact_movie_analytics", "id_dim_location"),
    _uq("fact_movie_analytics", "id_dim_os"),
    _nn("fact_movie_analytics", "id_dim_os"),
])


def _sql_text(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _long(one_row: DataFrame, checks: Sequence[Check], aliases: Sequence[str]) -> DataFrame:
    """One wide row of counts -> one report row per check (a single ``stack``)."""
    args = ", ".join(f"{_sql_text(c.model)}, {_sql_text(c.column)}, {_sql_text(c.test)}, "
                     f"CAST(`{a}` AS BIGINT)" for c, a in zip(checks, aliases))
    return one_row.select(F.expr(f"stack({len(checks)}, {args}) AS (model, `column`, test, failures)"))


def _fingerprint(text: str) -> tuple[str, str]:
    return f"xxhash64({text})", f"xxhash64('reelstar', {text})"


def column_value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column index, fingerprint, rows) of the non-null values of several columns in one
    shuffle; partial aggregation collapses a hot value in every task first."""
    pairs = ", ".join(f"struct({i} AS _c, CAST(`{c}` AS STRING) AS _v)" for i, c in enumerate(columns))
    h, g = _fingerprint("_v")
    return (df.selectExpr(f"inline(array({pairs}))").where("_v IS NOT NULL").selectExpr("_c", f"{h} AS _h", f"{g} AS _g")
            .groupBy("_c", "_h", "_g").agg(F.count(F.lit(1)).alias("_k")))


def null_checks(df: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """not_null checks of one model: a null count per column from one pass, one row a task shuffled."""
    counts = df.agg(*[F.count_if(F.col(c.column).isNull()).alias(f"_a{i}") for i, c in enumerate(checks)])
    return _long(counts, list(checks), [f"_a{i}" for i in range(len(checks))])


def value_checks(df: DataFrame, model: str, checks: Sequence[Check],
                 tables: Mapping[str, DataFrame]) -> DataFrame:
    """The other checks of one model in one aggregation over its (column, fingerprint, rows).

    The model is read once.  Relationship checks left-join the counted values
    of their column with the parent's distinct keys (cast to the child's
    type, compared by the fingerprint of their text, tagged with the column
    index), so an orphan is a counted value without a tag; accepted values are
    tested on the counted values.  One output branch per model -- nothing
    depends on Spark reusing a shared subplan.
    """
    columns = list(dict.fromkeys(c.column for c in checks))
    counts = column_value_counts(df, columns)
    h, g = _fingerprint("_v")
    for n, c in enumerate(ch for ch in checks if ch.test == RELATIONSHIPS):
        i = columns.index(c.column)
        child_type = df.schema[c.column].dataType
        keys = (tables[c.to].select(F.col(c.field).cast(child_type).cast("string").alias("_v"))
                .where("_v IS NOT NULL").selectExpr(f"{h} AS _h", f"{g} AS _g").distinct()
                .select(F.lit(i).alias("_c"), "_h", "_g", F.lit(True).alias(f"_hit{n}")))
        counts = counts.join(keys, ["_c", "_h", "_g"], "left")
    aggs, n_rel = [], 0
    for c in checks:
        i = columns.index(c.column)
        alias = f"`_a{len(aggs)}`"
        if c.test == UNIQUE:
            aggs.append(f"count_if(_c = {i} AND _k > 1) AS {alias}")
        elif c.test == RELATIONSHIPS:
            aggs.append(f"coalesce(sum(CASE WHEN _c = {i} AND _hit{n_rel} IS NULL THEN _k END), 0) AS {alias}")
            n_rel += 1
        else:
            child_type = df.schema[c.column].dataType.simpleString()
            allowed = [_fingerprint(f"CAST(CAST({v!r} AS {child_type}) AS STRING)") for v in c.values]
            known = " OR ".join(f"(_h = {x} AND _g = {y})" for x, y in allowed) or "false"
            aggs.append(f"count_if(_c = {i} AND NOT ({known})) AS {alias}")
    return _long(counts.selectExpr(*aggs), list(checks), [f"_a{i}" for i in range(len(aggs))])


def model_checks(df: DataFrame, model: str, checks: Sequence[Check],
                 tables: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of one model."""
    nulls = [c for c in checks if c.test == NOT_NULL]
    values = [c for c in checks if c.test != NOT_NULL]
    parts = [null_checks(df, model, nulls)] if nulls else []
    parts += [value_checks(df, model, values, tables)] if values else []
    return reduce(DataFrame.unionByName, parts)


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Run a list of checks; one output row per check, one pass per model for nulls and one for values."""
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        by_model.setdefault(c.model, []).append(c)
    parts = [model_checks(tables[m], m, mine, tables) for m, mine in by_model.items()]
    return reduce(DataFrame.unionByName, parts)


def checks_of_kind(kind: str, suite: Sequence[Check] = DECLARED_SUITE) -> list[Check]:
    return [c for c in suite if c.test == kind]
