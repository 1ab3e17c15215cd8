"""Estimators as grouped aggregates: proportions, medians, survival, bootstrap."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstat.functions.intervals import MIN_N_MEDIAN, MIN_N_PROPORTION, Z95, garwood, wilson
from wardstat.functions.md5 import numbered_md5
from wardstat.session import cut_lineage

REPS, SEED = 2000, 20260923


def proportion(counts: DataFrame, x: str = "x", n: str = "n", min_n: int = MIN_N_PROPORTION) -> DataFrame:
    """Add value, ci_low, ci_high, suppressed from successes and trials."""
    low, high = wilson(F.col(x), F.col(n))
    shown = F.col(n) >= min_n
    return (counts.withColumn("value", F.when(shown, F.col(x) / F.col(n)))
            .withColumn("ci_low", F.when(shown, low)).withColumn("ci_high", F.when(shown, high))
            .withColumn("suppressed", ~F.coalesce(shown, F.lit(False))))


def flag_proportion(df: DataFrame, cells: list[str], flag: Column, min_n: int = MIN_N_PROPORTION) -> DataFrame:
    agg = df.groupBy(*cells).agg(F.count_if(flag).alias("x"), F.count(F.lit(1)).alias("n"))
    return proportion(agg, min_n=min_n).drop("x")


def roll_up(df: DataFrame, by: list[str], levels: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """Sums per ``by`` and area. Records are added up per combination of areas first;
    only those few rows are then repeated for every level."""
    from wardstat.operators.joins import by_area
    leaf = df.groupBy(*by, *[c.alias(f"_lv_{g}") for g, c in levels.items()]).agg(*[c.alias(k) for k, c in sums.items()])
    out = by_area(leaf, {g: F.col(f"_lv_{g}") for g in levels})
    return out.groupBy(*by, "geo_type", "geo_id").agg(*[F.sum(k).alias(k) for k in sums])


def area_proportion(df: DataFrame, by: list[str], levels: dict[str, Column], flag: Column, min_n: int = MIN_N_PROPORTION) -> DataFrame:
    r = roll_up(df, by, levels, {"x": F.count_if(flag), "n": F.count(F.lit(1))})
    return proportion(r, min_n=min_n).drop("x")


def poisson_rate(counts: DataFrame, n: str, exposure: Column, per: float = 1.0) -> DataFrame:
    """Add value, ci_low, ci_high: count per exposure with exact Poisson bounds."""
    g = garwood(F.col(n))
    k = F.lit(float(per)) / F.nullif(exposure.cast("double"), F.lit(0.0))
    return (counts.withColumn("_g", g).withColumn("value", F.col(n) * k)
            .withColumn("ci_low", F.col("_g.low") * k).withColumn("ci_high", F.col("_g.high") * k).drop("_g"))


def odds(counts: DataFrame, d: str, n: str, min_n: int = 20) -> DataFrame:
    """d per n with the Wilson interval of d / (d + n) carried to the odds scale."""
    total = F.col(d) + F.col(n)
    low, high = wilson(F.col(d), total)
    shown = (total >= min_n) & (F.col(n) > 0)
    as_odds = lambda p: p / (1 - p)
    return (counts.withColumn("value", F.when(shown, F.col(d) / F.col(n)))
            .withColumn("ci_low", F.when(shown, as_odds(low)))
            .withColumn("ci_high", F.when(shown, as_odds(high)))
            .withColumn("suppressed", ~shown).withColumn("n_both", total))


# --- exact order statistics -----------------------------------------------

#: Distinct values that a rank is looked for among, and the parts that a stretch with more is divided into.
OPENED, PARTS = 50_000, 1024


def order_statistics(df: DataFrame, cells: list[str], value: str, ranks: dict[str, Column], spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One row per cell: n and, for each named rank (an expression of n), the value at it.

    Exact selection, however the values are spread. Equal values are counted first. A rank starts with its cell's whole
    stretch of values; while some stretch has more than ``OPENED`` distinct values it is divided into ``PARTS`` equal
    ones, their counts are added up, and each rank goes on with the part it falls into, from that part's least to its
    largest value. Only then are the stretches put in order. No task orders more than ``OPENED`` distinct values.

    Where a record counts in many cells, ``spread`` repeats rows for them: values are counted per combination of the other
    columns of ``df`` and stored once, and what is shuffled of the repeated rows is their sums per cell and part.
    """
    own = cells if spread is None else [c for c in df.columns if c != value]
    v = (df.where(F.col(value).isNotNull()).groupBy(*own, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c")))
    cell = F.struct(*cells, *([] if cells else [F.lit(0).alias("_all")]))
    v = cut_lineage(v.withColumn("_cell", cell)) if spread is None else spread(cut_lineage(v)).select(cell.alias("_cell"), "_v", "_c")
    # distinct values at most: repeated rows may share one, and a stretch of a single value is not divided
    distinct = F.when(F.min("_v") == F.max("_v"), F.lit(1)).otherwise(F.count("*"))
    whole = v.groupBy("_cell").agg(F.sum("_c").alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), distinct.alias("_d"))
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), e.cast("bigint").alias("rank")) for k, e in ranks.items()])
    at = whole.select("_cell", "n", "_lo", "_hi", "_d", F.lit(0).cast("bigint").alias("_before"), F.inline(wanted)).where("rank between 1 and n")
    at = cut_lineage(at)
    stretch = ["_cell", "_lo", "_hi"]
    while (at.agg(F.max("_d")).first()[0] or 0) > OPENED:
        wide = at.where(F.col("_d") > OPENED)
        step = (F.col("_hi") - F.col("_lo")) / PARTS
        part = F.least(F.lit(PARTS - 1), F.floor((F.col("_v") - F.col("_lo")) / step))
        divided = (v.join(wide.select(*stretch).distinct(), "_cell").where("_v between _lo and _hi").withColumn("_part", part)
                   .groupBy(*stretch, "_part").agg(F.sum("_c").alias("_pc"), F.min("_v").alias("_plo"), F.max("_v").alias("_phi"), distinct.alias("_pd")))
        upto = F.sum("_pc").over(Window.partitionBy(*stretch).orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
        narrowed = (wide.drop("_d").join(divided.withColumn("_upto", upto), stretch)
                    .where((F.col("rank") - F.col("_before") <= F.col("_upto")) & (F.col("rank") - F.col("_before") > F.col("_upto") - F.col("_pc"))))
        narrowed = narrowed.select("_cell", "n", F.col("_plo").alias("_lo"), F.col("_phi").alias("_hi"), F.col("_pd").alias("_d"), (F.col("_before") + F.col("_upto") - F.col("_pc")).alias("_before"), "name", "rank")
        at = cut_lineage(at.where(F.col("_d") <= OPENED).unionByName(narrowed))
    asked = at.groupBy(*stretch, "n", "_before").agg(F.collect_list(F.struct("name", "rank")).alias("_want"))
    upto = F.col("_before") + F.sum("_c").over(Window.partitionBy(*stretch).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    if spread is not None:                        # rows of one value are one before they are put in order
        open_ = v.join(asked.select(*stretch), "_cell").where("_v between _lo and _hi").groupBy(*stretch, "_v").agg(F.sum("_c").alias("_c"))
        found = open_.join(asked, stretch)
    else:
        found = v.join(asked, "_cell").where("_v between _lo and _hi")
    rows = (found.withColumn("_upto", upto)
            .withColumn("_want", F.filter("_want", lambda r: (r.rank <= F.col("_upto")) & (r.rank > F.col("_upto") - F.col("_c"))))
            .where(F.size("_want") > 0).withColumn("_w", F.explode("_want")))
    return rows.groupBy("_cell").agg(F.max("n").alias("n"), *[
        F.max(F.when(F.col("_w.name") == k, F.col("_v"))).alias(k) for k in ranks]).select(*[F.col(f"_cell.{c}").alias(c) for c in cells], "n", *ranks)


def quantiles(df: DataFrame, cells: list[str], value: str, probs: dict[str, float],
              extra: dict[str, Column] | None = None, spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Linear-interpolation quantiles, h = (n - 1) p, plus any extra ranks asked for; ``spread`` as in ``order_statistics``."""
    ranks = dict(extra or {})
    for name, p in probs.items():
        h = (F.col("n") - 1) * F.lit(p)
        ranks[f"_{name}_lo"] = F.floor(h) + 1
        ranks[f"_{name}_hi"] = F.ceil(h) + 1
    out = order_statistics(df, cells, value, ranks, spread)
    for name, p in probs.items():
        h = (F.col("n") - 1) * F.lit(p)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        out = out.withColumn(name, lo + (h - F.floor(h)) * (hi - lo))
    return out.drop(*[f"_{k}_{s}" for k in probs for s in ("lo", "hi")])


def bootstrap_ranks(z: float = Z95) -> dict[str, Column]:
    """Ranks whose values bound the percentile bootstrap of the median.

    P(resampled median <= x(k)) is P(Bin(n, k/n) >= (n+1)/2); its 2.5% and 97.5%
    points lie at n/2 -+ z sqrt(n)/2. The bound is thus two order statistics,
    with no resampling and no random numbers.
    """
    n = F.col("n").cast("double")
    half = z * F.sqrt(n) / 2
    return {"rank_low": F.greatest(F.lit(1), F.ceil(n / 2 - half)),
            "rank_high": F.least(F.col("n"), F.ceil(n / 2 + half))}


def median_metric(df: DataFrame, cells: list[str], value: str,
                  min_n: int = MIN_N_MEDIAN, spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """value, ci_low, ci_high, n, suppressed for the median of each cell; ``spread`` as in ``order_statistics``."""
    ranks = bootstrap_ranks()
    q = quantiles(df, cells, value, {"median": 0.5},
                  {"low": ranks["rank_low"], "high": ranks["rank_high"]}, spread)
    shown = F.col("n") >= min_n
    return q.select(*cells, F.when(shown, F.col("median")).alias("value"), F.when(shown, F.col("low")).alias("ci_low"),
                    F.when(shown, F.col("high")).alias("ci_high"), "n", (~shown).alias("suppressed"))


def poisson_steps(digits: int = 8) -> list[str]:
    """Hexadecimal bounds of a uniform number: a Poisson(1) draw is how many of them it is not below."""
    out, p, total, k = [], math.exp(-1.0), 0.0, 0
    while math.ceil((total := total + p) * 16**digits) < 16**digits:
        out.append(f"{math.ceil(total * 16**digits):0{digits}x}")
        p /= (k := k + 1)
    return out


#: Copies of values that one task draws weights for, and the sums that it hands on at a time.
DRAWN_COPIES, SUMS_ROWS = 100_000, 20_000


def _drawn_sums(cells: list[str], reps: int):
    """Weights of the copies of a batch and their sums per cell and four replicates."""
    names = [*cells, "b", *[f"{s}{k}" for k in range(4) for s in "ws"]]
    bounds = np.array([int(s, 16) for s in poisson_steps()], np.uint32)

    def cell_codes(batch: pa.RecordBatch) -> np.ndarray:
        codes = np.zeros(batch.num_rows, np.int64)
        for c in cells:
            one = batch.column(c).dictionary_encode("encode")
            codes = np.unique(codes * max(1, len(one.dictionary)) + one.indices.to_numpy(), return_inverse=True)[1]
        return codes

    def rows(found: pa.RecordBatch, sums: list[tuple]) -> pa.RecordBatch:
        b, *columns = zip(*sums)
        every = np.tile(np.arange(found.num_rows), len(b))
        numbers = [np.repeat(np.array(b, np.int32), found.num_rows), *map(np.concatenate, columns)]
        return pa.RecordBatch.from_arrays([*(found.column(c).take(pa.array(every)) for c in cells), *map(pa.array, numbers)], names)

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = cell_codes(batch)
            n, found = codes.max() + 1, batch.take(pa.array(np.unique(codes, return_index=True)[1]))
            order, digests = numbered_md5(batch.column("named"), -(-reps // 4))
            codes, x = codes[order], batch.column("x").fill_null(0.0).to_numpy()[order]
            sums = []
            for b, digest in digests:
                one = [b]
                for u in digest:
                    w = np.zeros(len(u), np.uint8)
                    for bound in bounds:
                        w += u >= bound
                    w = w.astype(np.float64)
                    one += [np.bincount(codes, w, n).astype(np.int64), np.bincount(codes, w * x, n)]
                sums.append(one)
                if len(sums) * n >= SUMS_ROWS:
                    yield rows(found, sums)
                    sums = []
            if sums:
                yield rows(found, sums)

    return run


def bootstrap_total(df: DataFrame, cells: list[str], value: str, reps: int = REPS, seed: int = SEED) -> DataFrame:
    """n, total, ci_low, ci_high: percentile bootstrap of the sum of each cell.

    Resampling n values with replacement is drawn as Poisson(1) weights with a ratio correction, n * sum(wx) / sum(w).
    Weights come by inversion from the digits of a hash of seed, cell, value, which copy of the value it is, and
    replicate, four replicates to a hash; values are told apart to four decimals. The result depends on neither
    partitioning nor record order, any engine with the same hash draws alike, and only copies and (cell, four replicates)
    sums are shuffled. A task hashes and adds up a batch of copies at once for each number, in arrays: column functions
    took about 2 microseconds a hash.
    """
    v = (df.where(F.col(value).isNotNull()).groupBy(*cells, F.col(value).cast("double").alias("x")).agg(F.count(F.lit(1)).alias("c")))
    v = cut_lineage(v)
    n = v.agg(F.sum("c")).first()[0] or 0
    total = v.groupBy(*cells).agg(F.sum("c").alias("n"), F.sum(F.col("x") * F.col("c")).alias("total"))
    # what is hashed differs by its last number only: the rest is written once per copy, not once per draw
    named = F.concat_ws(":", F.lit(f"w:{seed}"), *[F.col(c).cast("string") for c in cells], F.col("x").cast("decimal(24,4)").cast("string"))
    copies = v.withColumn("named", named).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "c")))
    copies = copies.select(*cells, "x", F.concat_ws(":", "named", F.col("copy").cast("string"), F.lit("")).alias("named"))
    # a copy is few bytes but ``reps`` draws: dealt by number, not by size, so that every core draws
    copies = copies.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // DRAWN_COPIES)), "named")
    sums_of = [T.StructField(f"{s}{k}", t) for k in range(4) for s, t in (("w", T.LongType()), ("s", T.DoubleType()))]
    draws = copies.mapInArrow(_drawn_sums(cells, reps), T.StructType([*(copies.schema[c] for c in cells), T.StructField("b", T.IntegerType()), *sums_of]))
    sums = draws.groupBy(*cells, "b").agg(*[F.sum(f"{s}{k}").alias(f"{s}{k}") for k in range(4) for s in "ws"])
    each = F.array(*[F.struct((F.col("b") * 4 + k).alias("rep"), F.col(f"w{k}").alias("w"), F.col(f"s{k}").alias("wx")) for k in range(4)])
    # at most ``reps`` rows per cell reach this percentile
    sims = (sums.select(*cells, F.inline(each)).where(F.col("rep") < reps).join(total.select(*cells, "n"), cells)
            .withColumn("s", F.col("n") * F.col("wx") / F.nullif(F.col("w").cast("double"), F.lit(0.0))))
    ci = sims.groupBy(*cells).agg(F.percentile("s", 0.025).alias("ci_low"), F.percentile("s", 0.975).alias("ci_high"))
    return total.join(ci, cells)


POWERS = ("n", "s1", "s2", "s3", "s4")


def power_sums(x: Column, prefix: str = "") -> list[Column]:
    """Count and sums of the first four powers (nulls left out): additive, so cells can be rolled up."""
    return [F.count(x).alias(prefix + "n")] + [F.coalesce(F.sum(F.pow(x, k)), F.lit(0.0)).alias(f"{prefix}s{k}") for k in (1, 2, 3, 4)]


def total_interval(sums: DataFrame) -> DataFrame:
    """Add total, ci_low, ci_high from power sums: what resampling the values would give.

    A resampled sum has known moments, so its percentiles come from the
    Cornish-Fisher expansion of mean, variance, skewness and kurtosis, for cells
    of any size.
    """
    n = F.col("n").cast("double")
    m1, m2, m3, m4 = (F.col(f"s{k}") / n for k in (1, 2, 3, 4))
    var = F.greatest(F.lit(0.0), m2 - m1 * m1)
    c3 = m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1
    c4 = m4 - 4 * m1 * m3 + 6 * m1 * m1 * m2 - 3 * F.pow(m1, 4)
    g = F.when(var > 0, c3 / F.pow(var, 1.5)).otherwise(0.0) / F.sqrt(n)
    k = F.when(var > 0, c4 / (var * var) - 3).otherwise(0.0) / n

    def edge(z: float) -> Column:
        w = z + (z * z - 1) * g / 6 + (z**3 - 3 * z) * k / 24 - (2 * z**3 - 5 * z) * g * g / 36
        return F.col("s1") + w * F.sqrt(n * var)

    return sums.withColumn("total", F.col("s1")).withColumn("ci_low", edge(-Z95)).withColumn("ci_high", edge(Z95))


# --- Kaplan-Meier -----------------------------------------------------------

KM_TOL = 1.5e-8


def km_counts(df: DataFrame, cells: list[str], time: str, event: Column) -> DataFrame:
    """Closed (events) and still-open (censored) records per cell and duration."""
    return (df.where(F.col(time).isNotNull()).groupBy(*cells, F.col(time).alias("time"))
            .agg(F.count_if(event).alias("events"), F.count_if(~event).alias("censored")))


def km_median(counts: DataFrame, cells: list[str], min_n: int = MIN_N_MEDIAN) -> DataFrame:
    """Kaplan-Meier median with log-log interval from counts per duration.

    A curve sitting exactly at 0.5 gives the midpoint to the next event time. A
    median never reached is suppressed; an upper bound never reached is +inf.
    The windows run over one row per distinct duration, not per record.
    """
    w = Window.partitionBy(*cells).orderBy("time")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*cells)
    at = F.col("events") + F.col("censored")
    c = (counts.where(at > 0).withColumn("n", F.sum(at).over(whole))
         .withColumn("r", F.col("n") - F.sum(at).over(upto) + at)
         .withColumn("d", F.col("events").cast("double")))
    gone = (F.col("d") == F.col("r")) & (F.col("d") > 0)
    c = (c.withColumn("log_s", F.sum(F.when(~gone, F.log(1 - F.col("d") / F.col("r")))).over(upto))
         .withColumn("green", F.sum(F.when(~gone, F.col("d") / (F.col("r") * (F.col("r") - F.col("d"))))).over(upto))
         .withColumn("s", F.when(gone, 0.0).otherwise(F.exp("log_s"))))
    # Only event times carry the curve; the next event time is needed for ties.
    later = w.rowsBetween(1, Window.unboundedFollowing)
    e = c.withColumn("nxt", F.min(F.when(F.col("events") > 0, F.col("time"))).over(later))
    centre = F.log(-F.col("log_s"))
    half = Z95 * F.sqrt("green") / F.abs("log_s")
    zero = F.col("s") == 0
    e = (e.withColumn("s_lo", F.when(zero, 0.0).otherwise(F.exp(-F.exp(centre + half))))
         .withColumn("s_hi", F.when(zero, 0.0).otherwise(F.exp(-F.exp(centre - half)))))

    def crossing(s: str) -> Column:
        here = F.when((F.abs(F.col(s) - 0.5) < KM_TOL) & F.col("nxt").isNotNull(),
                      (F.col("time") + F.col("nxt")) / 2.0).otherwise(F.col("time").cast("double"))
        return F.min_by(here, F.when((F.col("events") > 0) & (F.col(s) <= 0.5 + KM_TOL), F.col("time")))

    est = e.groupBy(*cells).agg(F.max("n").alias("n"), crossing("s").alias("m"), crossing("s_lo").alias("lo"),
                                crossing("s_hi").alias("hi"))
    shown = (F.col("n") >= min_n) & F.col("m").isNotNull()
    return est.select(
        *cells, F.when(shown, F.col("m")).alias("value"), F.when(shown, F.col("lo")).alias("ci_low"),
        F.when(shown, F.coalesce("hi", F.lit(float("inf")))).alias("ci_high"), "n", (~shown).alias("suppressed"))


def over_disk(per_cell: DataFrame, cell: str, by: list[str], sums: list[str]) -> DataFrame:
    """Sum per-cell counts over each cell and its six neighbours.

    Every cell sends its counts to the seven disks it belongs to; the input is
    already one row per cell, so the explode is small.
    """
    from wardstat.functions.geo import hex_disk
    return (per_cell.where(F.col(cell).isNotNull())
            .withColumn("geo_id", F.explode(hex_disk(F.col(cell))))
            .groupBy("geo_id", *by).agg(*[F.sum(s).alias(s) for s in sums]))


# --- apportionment, standardisation, pooling --------------------------------

def null_sum(c: Column) -> Column:
    """Sum that is missing when any term is missing."""
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def even_share(df: DataFrame, group: list[str], value: str | dict[str, str], out: str = "share") -> DataFrame:
    """Share of the group total; an even split when the total is zero.

    ``value`` may name several values and their shares: the groups are added up once for all of them.
    """
    values = {value: out} if isinstance(value, str) else value
    tot = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_cnt"), *[F.sum(v).alias(f"_tot_{v}") for v in values])
    share = lambda v: F.when(F.col(f"_tot_{v}") > 0, F.col(v) / F.col(f"_tot_{v}")).otherwise(1.0 / F.col("_cnt"))
    return df.join(tot, group).withColumns({o: share(v) for v, o in values.items()}).drop("_cnt", *[f"_tot_{v}" for v in values])


def apportion(bg: DataFrame, blocks: DataFrame, levels: dict[str, str], hu_vars: list[str] = ()) -> DataFrame:
    """Split block-group values across areas by block weights.

    ``bg``: bg, variable, estimate, moe. ``blocks``: bg, weight_pop, weight_hu
    and a column per level. Pieces of one block group in one area move together,
    so their weights are added before margins are squared.
    """
    from wardstat.operators.joins import by_area
    w = (by_area(blocks, {g: F.col(c) for g, c in levels.items()})
         .groupBy("geo_type", "geo_id", "bg").agg(F.sum("weight_pop").alias("wp"), F.sum("weight_hu").alias("wh")))
    wt = F.when(F.col("variable").isin(*hu_vars), F.col("wh")).otherwise(F.col("wp")) if hu_vars else F.col("wp")
    m = w.join(bg, "bg").withColumn("e", F.col("estimate") * wt).withColumn("m2", F.pow(F.col("moe") * wt, 2))
    return m.groupBy("geo_type", "geo_id", "variable").agg(
        null_sum(F.col("e")).alias("estimate"), F.sqrt(null_sum(F.col("m2"))).alias("moe"))


def derive_measures(components: DataFrame, measures: list[tuple]) -> DataFrame:
    """Published measures from components: value, moe and reliability per area.

    ``measures``: (id, unit, numerator, denominator) with variables joined by
    '+'. Fails on an unknown or repeated variable.
    """
    from wardstat.functions.intervals import acs_moe_proportion, acs_moe_ratio, acs_reliability
    need = {v for _, _, num, den in measures for v in (num + ("+" + den if den else "")).split("+")}
    have = {r[0] for r in components.where(F.col("variable").isin(*need)).select("variable").distinct().collect()}
    if need - have:
        raise ValueError("missing variables: " + ", ".join(sorted(need - have)))
    spec = F.array(*[F.struct(F.lit(i).alias("measure"), F.lit(u).alias("unit"), F.lit(part).alias("part"),
                              F.lit(v).alias("variable"), F.lit(bool(d)).alias("has_den"))
                     for i, u, nu, d in measures for part, text in (("n", nu), ("d", d)) if text
                     for v in text.split("+")])
    c = components.withColumn("_m", F.explode(F.filter(spec, lambda s: s.variable == F.col("variable"))))
    side = lambda p, col: F.when(F.col("_m.part") == p, col)
    agg = c.groupBy("geo_type", "geo_id", F.col("_m.measure").alias("measure"), F.col("_m.unit").alias("unit"),
                    F.col("_m.has_den").alias("has_den"))
    missing = lambda p, col: F.count_if((F.col("_m.part") == p) & F.col(col).isNull()) == 0
    a = agg.agg(*[F.when(missing(p, "estimate"), F.sum(side(p, F.col("estimate")))).alias(p) for p in "nd"],
                *[F.when(missing(p, "moe"), F.sqrt(F.sum(side(p, F.pow("moe", 2))))).alias(f"{p}_moe") for p in "nd"])
    n, d, nm, dm = (F.col(x) for x in ("n", "d", "n_moe", "d_moe"))
    value = F.when(~F.col("has_den"), n).when(d > 0, n / d)
    moe = (F.when(~F.col("has_den"), nm)
           .when((d > 0) & (F.col("unit") == "proportion"), acs_moe_proportion(n, d, nm, dm))
           .when(d > 0, acs_moe_ratio(n, d, nm, dm)))
    out = a.withColumn("value", value).withColumn("moe", moe)
    return out.select("geo_type", "geo_id", "measure", "value", "moe",
                      acs_reliability(F.col("value"), F.col("moe")).alias("reliability"))


def standardized_ratio(rows: DataFrame, area: str, group: str, flag: Column, min_n: int = MIN_N_PROPORTION) -> DataFrame:
    """Observed against expected: each record expects its group's overall share.

    Only per (group, area) counts are joined back, never records.
    """
    g = rows.groupBy(group, area).agg(F.count(F.lit(1)).alias("m"), F.count_if(flag).alias("k"))
    p = g.groupBy(group).agg((F.sum("k") / F.sum("m")).alias("p"))
    t = (g.where(F.col(area).isNotNull()).join(p, group).groupBy(area).agg(
        F.sum("m").alias("n"), F.sum("k").cast("double").alias("observed"),
        F.sum(F.col("m") * F.col("p")).alias("expected"),
        F.sum(F.col("m") * F.col("p") * (1 - F.col("p"))).alias("null_var")))
    low, high = wilson(F.col("observed"), F.col("n"))
    scale = F.nullif(F.col("expected") / F.col("n"), F.lit(0.0))
    return (t.withColumn("ratio", F.col("observed") / F.nullif(F.col("expected"), F.lit(0.0)))
            .withColumn("ci_low", low / scale).withColumn("ci_high", high / scale)
            .withColumn("suppressed", F.col("n") < min_n))


def category_shares(rows: DataFrame, group: str, code: Column, min_share: float = 0.05) -> DataFrame:
    """Share of each code in its group; codes small in every group become 'other codes'."""
    clean = F.when(code.isNull() | (F.trim(code) == ""), "(no code)").otherwise(F.trim(code))
    c = rows.where(F.col(group).isNotNull()).groupBy(group, clean.alias("code")).agg(F.count(F.lit(1)).alias("k"))
    tot = c.groupBy(group).agg(F.sum("k").alias("n_group"))
    s = c.join(tot, group)
    keep = s.groupBy("code").agg((F.max(F.col("k") / F.col("n_group")) >= min_share).alias("big"))
    return (s.join(keep, "code").withColumn("code", F.when(F.col("big"), F.col("code")).otherwise("other codes"))
            .groupBy(group, "code").agg((F.sum("k") / F.max("n_group")).alias("share"),
                                        F.max("n_group").alias("n_group")))
