"""Mixing sources to target weights by Poisson replication. DataFrame functions only.

A source with weight w (share of the mixture) and n of the N rows is repeated
``epochs * w * N / n`` times on average. Each row draws its own number of copies
from a Poisson distribution with that mean: a uniform number made from the md5
of the seed and the row's id goes through the inverse of the distribution
function, so the draw depends on nothing but the row and can be made again
anywhere. The row is exploded by its number, and all copies are put in the
order of a second md5, of seed, id and copy: a global shuffle.

A rate above ``PART`` is the sum of equal parts of at most ``PART``, each with a
draw of its own (md5 of seed, id and the part's number; the first part's is that
of seed and id), as the inverse starts from exp(-rate), which is 0 in a double
for rates above 745. Sums of Poisson numbers are Poisson numbers.

No count is drawn per source and no source meets in one task, so a source that
holds a third of all rows costs no more per row than others.

Defined results: a null source is a source of its own and takes part only if
``weights`` names null; a source without weight, or with weight 0, is left out;
weights are normalised over the sources that are there; a null id draws as the
text 'null'; repeated rows draw alike; empty tables stay empty; other columns
pass through, and columns named like results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import small

SEED = 20
#: Largest rate that is drawn at once.
PART = 256.0
#: Shares of a table's rows, over 52 random bits.
_DIGITS = 13


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the md5 of the parts joined by ':'."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(16 ** _DIGITS))


def poisson_top(rate: float) -> int:
    """Beyond this count lies less than 2**-53 of a Poisson distribution."""
    k, term, total = 0, math.exp(-rate), math.exp(-rate)
    # the sum can stay under 1 by rounding: then the terms are too small to count
    while (1 - total > 2.0 ** -53 and term > 2.0 ** -60) or k < rate:
        k += 1
        term *= rate / k
        total += term
        if k > 20 * rate + 60:
            break
    return k


def poisson_steps(rate: Column, top: int) -> Column:
    """Distribution function at 0, 1, ..., top as an array."""
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("c"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(top)), first, step)["c"]


def rates(docs: DataFrame, weights: DataFrame, source_col: str = "source", epochs: float = 1.0) -> DataFrame:
    """(source, n_rows, rate) of the sources that have rows and a weight."""
    rows = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    w = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight")).where("weight > 0")
    got = rows.join(w, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    # one row per source: the totals are of that small table and of the row counts
    all_rows, all_weight = rows.agg(F.sum("n_rows")).scalar(), got.agg(F.sum("weight")).scalar()
    return got.select("source", "n_rows", (F.lit(float(epochs)) * F.col("weight") / all_weight * all_rows / F.col("n_rows")).alias("rate"))


def mix(docs: DataFrame, weights: DataFrame, id_col: str = "doc_id", source_col: str = "source", epochs: float = 1.0,
        seed: int = SEED) -> DataFrame:
    """``docs`` repeated, in mixed order, with rate, n_copies, copy (from 0) and
    mix_key (52 random bits, the order)."""
    plan = rates(docs, weights, source_col, epochs)
    plan = plan.withColumn("_parts", F.greatest(F.ceil(F.col("rate") / PART), F.lit(1)))
    most = plan.agg(F.max(F.col("rate") / F.col("_parts"))).first()[0]
    top = poisson_top(most or 0.0)
    plan = plan.select(F.col("source").alias("_s"), "rate", "_parts", poisson_steps(F.col("rate") / F.col("_parts"), max(top, 1)).alias("_steps"))
    names = [c for c in docs.columns if c not in ("rate", "n_copies", "copy", "mix_key")]
    kept = [F.col(f"`{c}`") for c in names]
    joined = docs.select(*kept).join(small(plan), F.col(source_col).eqNullSafe(F.col("_s")))

    def drawn_at(u: Column) -> Column:
        return F.size(F.filter("_steps", lambda c: c < u)).cast("long")

    more = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("_parts") - 1), F.lit(0).cast("long"),
                       lambda n, part: n + drawn_at(uniform(F.lit(seed), F.col(id_col), F.lit("part"), part)))
    count = drawn_at(uniform(F.lit(seed), F.col(id_col))) + F.when(F.col("_parts") > 1, more).otherwise(F.lit(0).cast("long"))
    drawn = joined.select(*kept, "rate", count.alias("n_copies")).where("n_copies > 0")
    copies = drawn.select("*", F.explode(F.sequence(F.lit(0), F.col("n_copies").cast("int") - 1)).alias("copy"))
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), "copy")), 1, _DIGITS), 16, 10)
    return copies.withColumn("mix_key", key.cast("long")).orderBy("mix_key")


def mix_sql(weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = SEED, columns: str = "doc_id, source", top: int = 400) -> str:
    """DuckDB SQL for the rows of ``mix`` over ``documents``; without weights
    each source alike."""
    given = "select distinct source, 1.0 from documents" if weights is None else "values " + ", ".join(f"('{s}', {w!r})" for s, w in weights.items())
    return f"""
with weights(source, weight) as ({given}),
n as (select source, count(*) as n_rows from documents group by source),
got as (select n.source, n_rows, weight::double as weight from n join weights w on n.source is not distinct from w.source where weight > 0),
r as (select source, {float(epochs)!r}::double * weight / (select sum(weight) from got) * (select sum(n_rows) from n)::double / n_rows as rate from got),
steps as (select source, rate, k, list_sum(list_transform(range(0, k + 1),
              lambda i: exp(-rate + i * ln(rate) - lgamma(i + 1)))) as c from r, range(0, {top}) t(k)),
u as (select *, (('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, 'null')), 1, {_DIGITS}))::bigint + 0.5::double) / {float(16 ** _DIGITS)!r}::double as u from documents),
drawn as (select u.*, s.rate, (select count(*) from steps t where t.source is not distinct from u.source and t.c < u.u) as n_copies
          from u join r s on u.source is not distinct from s.source)
select {columns}, rate, n_copies, copy, ('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, 'null') || ':' || copy), 1, {_DIGITS}))::bigint as mix_key
from (select *, unnest(range(0, n_copies))::integer as copy from drawn where n_copies > 0)"""
