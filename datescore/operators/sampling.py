"""Exact, seeded sampling and splitting.

Contract: exact sizes, no replacement, the same rows for the same seed on any
partitioning, disjoint parts, and no row is lost: a missing key field or group
is a value like any other. Rows are ordered by a seeded md5 of their key
(``functions.hashing``) and ranked within their group.

Ranking without a single-task window
------------------------------------
A plain ``row_number() over (partition by label order by h)`` puts a whole
class into one task. Instead the leading hex digits of ``h`` split every
group into 65,536 buckets of (md5 being uniform) equal size:

1. count rows per (group, bucket): partial aggregation, tiny output;
2. a running sum over the buckets of a group gives each bucket's offset
   (at most 65,536 rows per group);
3. a bucket that lies wholly before rank k is in, one that starts at or after
   k is out, so one cut per group decides by comparison; only the one boundary
   bucket per group is ranked, per distinct hash (copies of a key collapse
   before the shuffle).

Full ranks (folds) add the offsets of distinct hashes within their bucket;
the copies of one key are spread over SALTS windows, and rows that repeat in
full are counted and repeated at the end, so no key gathers in one task.

The operators read their input more than once: give them a written table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datescore.functions.hashing import fields_text, hash_bucket, seeded_hash
from datescore.session import materialize
from datescore.schema import KEY, LABEL

HEX_DIGITS = 4  # 16**4 = 65,536 buckets per group
SALTS = 256  # windows that share the copies of one key in a full ranking
COPY_BLOCK = 10_000  # rows one task repeats of a row that stands many times

# The reference's seeds for the class samples and the split.
POSITIVE_SEED = 1
NEGATIVE_SEED = 43
SPLIT_SEED = 43
FOLD_SEED = 90
# Hash streams of the split and the folds, so their orders do not repeat the
# class sample's order (which uses no stream).
SPLIT_STREAM = "split"
FOLD_STREAM = "fold"

KSpec = int | Callable[[Column], Column]


def _bucketed(df: DataFrame, order_hash: Column, groups: list[str]) -> DataFrame:
    """Order hash ``_h``, its bucket ``_b`` and the group as one never-null text ``_g``."""
    return (
        df.withColumn("_h", order_hash).withColumn("_b", hash_bucket(F.col("_h"), HEX_DIGITS)).withColumn("_g", fields_text(groups))
    )


def _k_column(k: KSpec) -> Column:
    return F.lit(k) if isinstance(k, int) else k(F.col("_total"))


def flag_first_k(
    df: DataFrame,
    order_hash: Column,
    k: KSpec,
    groups: list[str] | None = None,
    flag: str = "sampled",
    require_k: bool = False,
    expected: DataFrame | None = None,
    what: str = "group",
) -> DataFrame:
    """All rows of ``df`` plus boolean ``flag``: rank (by ``order_hash``, within ``groups``) <= k.

    ``k`` is an int or a function of the group's row count (a Column), which may
    also use the group's text ``_g``. With ``require_k`` a group with fewer
    than k rows fails the job, naming it (as ``what``); ``expected`` (a frame of
    group values) makes absent groups fail too. The cuts are broadcast: callers
    give groups of a fixed number.

    Three reads of ``df``, two of them pruned to the key columns:
    1. counts per (group, bucket) -> one cut per group, written once under the
       shared folder (this runs when the function is called, so a short group
       fails here);
    2. the rows of the boundary buckets only, aggregated per distinct hash,
       decided and written (also at call time);
    3. one full scan deciding every row by two joins. The cuts are broadcast by
       their bound; the decisions are a written table, so Spark knows their
       size when it chooses the join.
    """
    groups = list(groups or [])
    d = _bucketed(df, order_hash, groups)
    cuts = _cuts(d, k, require_k, expected, groups, what)
    decided = materialize(edge_decisions(d, _edges(cuts)), "sample-edge")
    return _marked(d, cuts, decided, flag).select(*df.columns, flag)


def first_k_and_rest(
    df: DataFrame,
    order_hash: Column,
    k: KSpec,
    groups: list[str] | None = None,
    require_k: bool = False,
    expected: DataFrame | None = None,
    what: str = "group",
) -> tuple[DataFrame, DataFrame]:
    """The rows that ``flag_first_k`` flags and the others, as two frames.

    For a k that is small beside ``df``: after the counts, one full scan writes the
    rows up to the boundary buckets (at most k rows and one bucket a group), from
    which the boundary is decided and the first frame read. Only the others need
    another scan, when they are asked for.
    """
    groups = list(groups or [])
    d = _bucketed(df, order_hash, groups)
    cuts = _cuts(d, k, require_k, expected, groups, what)
    up_to = F.coalesce("_edge_b", "_last_b")
    near = d.join(F.broadcast(cuts.select("_g", up_to.alias("_up_to"))), "_g").where(F.col("_b") <= F.col("_up_to"))
    near = materialize(near.drop("_up_to"), "sample-near")
    decided = materialize(edge_decisions(near, _edges(cuts)), "sample-edge")
    first = _marked(near, cuts, decided, "_in").where(F.col("_in"))
    rest = _marked(d, cuts, decided, "_in").where(~F.col("_in"))
    return first.select(*df.columns), rest.select(*df.columns)


def _cuts(
    d: DataFrame, k: KSpec, require_k: bool, expected: DataFrame | None, groups: list[str], what: str
) -> DataFrame:
    """Where rank k falls, one row per group: ``_last_b``, the last bucket wholly inside, and the boundary bucket.

    ``_edge_b`` is null where k falls between two buckets; ``_before`` counts the rows below it.
    """
    counts = d.groupBy("_g", "_b").agg(F.count(F.lit(1)).alias("_n"))
    if expected is not None:
        absent = expected.select(fields_text(groups).alias("_g"), F.lit(-1).alias("_b"), F.lit(0).cast("long").alias("_n"))
        counts = counts.unionByName(absent)
    earlier = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = counts.select(
        "_g",
        "_b",
        "_n",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy("_g")).alias("_total"),
    )
    kcol = _k_column(k)
    before = F.col("_before")
    if require_k:
        msg = F.concat(
            F.lit("cannot sample "), kcol.cast("string"), F.lit(f" rows from [{what}="),
            F.regexp_replace("_g", r"\|(\d+:)?", ""), F.lit("] of "), F.col("_total").cast("string"), F.lit(" rows"),
        )
        before = F.when(F.col("_total") < kcol, F.raise_error(msg)).otherwise(before)
    inside = F.col("_before") + F.col("_n") <= F.col("_k")
    edge = ~inside & (F.col("_before") < F.col("_k"))
    # The buckets of a group are in order, so the inside ones come first and at most one is the edge.
    status = off.select("_g", "_b", "_n", before.alias("_before"), kcol.alias("_k")).groupBy("_g").agg(
        F.max(F.when(inside, F.col("_b"))).alias("_last_b"),
        F.max(F.when(edge, F.struct("_b", "_before", "_k"))).alias("_e"),
    )
    return materialize(
        status.select("_g", "_last_b", F.col("_e._b").alias("_edge_b"), F.col("_e._before").alias("_before"), F.col("_e._k").alias("_k")),
        "sample-cuts",
    )


def _edges(cuts: DataFrame) -> DataFrame:
    """The boundary buckets of ``_cuts``, as ``edge_decisions`` takes them."""
    return cuts.where(F.col("_edge_b").isNotNull()).select("_g", F.col("_edge_b").alias("_b"), "_before", "_k")


def _marked(d: DataFrame, cuts: DataFrame, decided: DataFrame, flag: str) -> DataFrame:
    """``d`` with the flag: inside by its bucket, or by the decision on its hash."""
    marked = d.join(F.broadcast(cuts.select("_g", "_last_b")), "_g").join(decided, ["_g", "_b", "_h"], "left")
    return marked.withColumn(flag, F.coalesce(F.col("_edge"), F.col("_b") <= F.col("_last_b"), F.lit(False)))


def edge_decisions(d: DataFrame, edge_status: DataFrame) -> DataFrame:
    """In or out for every distinct hash of the boundary buckets; robust to hot copies.

    Copies of one key share a hash. Boundary rows (key columns only) are
    aggregated per distinct hash, so any number of copies becomes one row
    per map task before the shuffle. The boundary bucket is split again by
    the next hex digits of the hash: sub-bucket offsets (at most 65,536 rows
    per group, broadcast) let each sub-bucket rank its distinct hashes on its
    own, so one window partition holds about 1/2^32 of a group.
    A hash whose copies straddle rank k cannot be split without an arbitrary
    choice: that is a duplicate key, an input error, and the job fails
    naming the hash.
    """
    edge = d.select("_g", "_b", "_h").join(F.broadcast(edge_status.select("_g", "_b", "_before", "_k")), ["_g", "_b"], "inner")
    sub_bucket = F.conv(F.substring(F.col("_h"), HEX_DIGITS + 1, HEX_DIGITS), 16, 10).cast("int")
    # About 1/65,536 of each group: written once, so the sub-bucket counts
    # and the ranking below read it instead of the input.
    per_hash = materialize(
        edge.withColumn("_b2", sub_bucket)
        .groupBy("_g", "_b", "_b2", "_h", "_before", "_k")
        .agg(F.count(F.lit(1)).alias("_c")),
        "sample-boundary",
    )
    sub_counts = per_hash.groupBy("_g", "_b", "_b2").agg(F.sum("_c").alias("_n2"))
    earlier_sub = Window.partitionBy("_g", "_b").orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)
    sub_offsets = sub_counts.select("_g", "_b", "_b2", F.coalesce(F.sum("_n2").over(earlier_sub), F.lit(0)).alias("_before2"))
    per_hash = per_hash.join(F.broadcast(sub_offsets), ["_g", "_b", "_b2"], "inner")
    earlier = Window.partitionBy("_g", "_b", "_b2").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_before") + F.col("_before2") + F.coalesce(F.sum("_c").over(earlier), F.lit(0))
    per_hash = per_hash.withColumn("_r0", start)
    straddles = (F.col("_r0") < F.col("_k")) & (F.col("_r0") + F.col("_c") > F.col("_k"))
    msg = F.concat(F.lit("duplicate key at the sampling boundary, order hash "), F.col("_h"))
    return per_hash.select(
        "_g",
        "_b",
        "_h",
        F.when(straddles, F.raise_error(msg)).otherwise(F.col("_r0") + F.col("_c") <= F.col("_k")).alias("_edge"),
    )


def rank_by_hash(df: DataFrame, order_hash: Column, groups: list[str] | None = None, name: str = "rank") -> DataFrame:
    """Exact 1-based rank of every row within its group, ordered by ``order_hash``.

    Distinct hashes are ranked within (group, hash bucket), about 1/65,536 of
    a group. Rows that share a hash follow each other by their content: they
    are spread over SALTS parts, and rows equal in all columns are one row with a count.
    """
    groups = list(groups or [])
    # Struct and map columns cannot be grouped; the feature tables have none.
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    content = F.md5(fields_text(df.columns))
    d = _bucketed(rows, order_hash, groups).withColumn("_x", content)
    d = materialize(d.withColumn("_t", F.pmod(F.xxhash64("_x"), F.lit(SALTS)).cast("int")), "rank-rows")
    buckets = d.groupBy("_g", "_b").agg(F.sum("_c").alias("_n"))
    earlier = Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bucket_start = buckets.select("_g", "_b", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    parts = d.groupBy("_g", "_b", "_h", "_t").agg(F.sum("_c").alias("_n"))
    within = Window.partitionBy("_g", "_b").orderBy("_h", "_t").rowsBetween(Window.unboundedPreceding, -1)
    part_start = parts.select("_g", "_b", "_h", "_t", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_in"))
    starts = part_start.join(bucket_start, ["_g", "_b"]).withColumn("_before", F.col("_before") + F.col("_in"))
    copies = Window.partitionBy("_g", "_b", "_h", "_t").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    joined = d.join(starts.drop("_in"), ["_g", "_b", "_h", "_t"])
    ranked = joined.withColumn(name, F.col("_before") + F.coalesce(F.sum("_c").over(copies), F.lit(0)) + 1)
    once = ranked.where(F.col("_c") == 1).select(*df.columns, name)
    many = ranked.where(F.col("_c") > 1).withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_c") - 1, F.lit(COPY_BLOCK).cast("long")))
    )
    repeated = (
        many.repartition("_h", "_at")
        .withColumn("_i", F.explode(F.sequence(F.col("_at"), F.least(F.col("_at") + COPY_BLOCK, F.col("_c")) - 1)))
        .withColumn(name, F.col(name) + F.col("_i"))
    )
    return once.unionByName(repeated.select(*df.columns, name))


# --- D1 / J1 / J2 -------------------------------------------------------------


def class_order_hash(seeds: dict[int, int] | None = None, key: list[str] | None = None) -> Column:
    """Seeded order key whose seed depends on the row's class (no seed outside the classes)."""
    seeds = seeds or {1: POSITIVE_SEED, 0: NEGATIVE_SEED}
    seed = F.lit("")
    for cls, s in seeds.items():
        seed = F.when(F.col(LABEL) == cls, F.lit(str(s))).otherwise(seed)
    return seeded_hash(seed, key or KEY)


def flag_class_sample(
    df: DataFrame, n: int, seeds: dict[int, int] | None = None, key: list[str] | None = None, flag: str = "sampled"
) -> DataFrame:
    """D1 as a flag: exactly ``n`` rows of each class 1 and 0 are ``flag`` = true.

    Rows with another (or no) label are never sampled; they form one group of
    their own, so all rows are flagged in one pass. A class with fewer than
    ``n`` rows fails the job with a message naming it.
    """
    d, order_hash, how = _class_ranks(df, n, seeds, key)
    return flag_first_k(d, order_hash, flag=flag, **how).select(*df.columns, flag)


def _class_ranks(df: DataFrame, n: int, seeds: dict[int, int] | None, key: list[str] | None) -> tuple[DataFrame, Column, dict]:
    """D1 in the terms of ``flag_first_k``: its frame, order and arguments."""
    seeds = seeds or {1: POSITIVE_SEED, 0: NEGATIVE_SEED}
    classes = list(seeds)
    d = df.withColumn("_class", F.when(F.col(LABEL).isin(*classes), F.col(LABEL)))
    # A class with no row at all must fail too: name every class as expected.
    wanted = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in classes])).alias("_class"))
    texts = [f"|{len(str(c))}:{c}" for c in classes]

    def k(total: Column) -> Column:
        return F.when(F.col("_g").isin(*texts), F.lit(n)).otherwise(F.lit(0))

    return d, class_order_hash(seeds, key), {"k": k, "groups": ["_class"], "require_k": True, "expected": wanted, "what": LABEL}


def class_sample_and_holdout(
    df: DataFrame, n: int, seeds: dict[int, int] | None = None, key: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """D1 + J2 and J1: the two class samples together, and every other row (no join: the sample's rank)."""
    d, order_hash, how = _class_ranks(df, n, seeds, key)
    sample, rest = first_k_and_rest(d, order_hash, **how)
    return sample.select(*df.columns), rest.select(*df.columns)


def class_sample(df: DataFrame, n: int, seeds: dict[int, int] | None = None, key: list[str] | None = None) -> DataFrame:
    """D1 + J2: the union of the two class samples (positives and negatives)."""
    return class_sample_and_holdout(df, n, seeds, key)[0]


def holdout(df: DataFrame, n: int, seeds: dict[int, int] | None = None, key: list[str] | None = None) -> DataFrame:
    """Every row that is in neither class sample (no join: the sample flag)."""
    return flag_class_sample(df, n, seeds, key).where(~F.col("sampled")).drop("sampled")


def holdout_anti_join(df: DataFrame, sample: DataFrame, key: list[str] | None = None) -> DataFrame:
    """J1 literally: all rows minus the sampled ones, on the row key (missing fields match each other)."""
    key = key or KEY
    other = sample.select(*[F.col(c).alias(f"_s_{c}") for c in key])
    on = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in key]
    return df.join(other, on, "left_anti").select(*df.columns)


def union_rows(*parts: DataFrame) -> DataFrame:
    """Concatenate rows by name, duplicates kept (UNION ALL)."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- D2 / D3 ------------------------------------------------------------------


def half_split(
    df: DataFrame, test_fraction: float = 0.5, seed: int = SPLIT_SEED, key: list[str] | None = None, flag: str = "is_test"
) -> DataFrame:
    """Exact split; the first ceil(N * test_fraction) rows by seeded hash are the test part."""
    frac = float(test_fraction)
    return flag_first_k(
        df, seeded_hash(seed, key or KEY, stream=SPLIT_STREAM), lambda total: F.ceil(total * F.lit(frac)), groups=[], flag=flag
    )


def fold_assign(
    df: DataFrame, folds: int = 3, seed: int = FOLD_SEED, key: list[str] | None = None, name: str = "fold"
) -> DataFrame:
    """D3: stratified folds: fold = (rank within class - 1) mod ``folds``."""
    ranked = rank_by_hash(df, seeded_hash(seed, key or KEY, stream=FOLD_STREAM), groups=[LABEL], name="_rank")
    return ranked.withColumn(name, ((F.col("_rank") - 1) % folds).cast("int")).drop("_rank")
