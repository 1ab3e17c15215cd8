"""Empirical-Bayes ratios, spatial lag, Moran's I and local Moran on an area table.

The permutation tests order the areas of each simulation by a hash of seed,
simulation and area, so any engine with the same hash draws alike. Simulations
are independent rows. A global one needs a whole order, a local one only its
first few places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardstat.operators.aggregates import SEED
from wardstat.operators.sequences import ordered
from wardstat.session import attach, cut_lineage, small_side

#: Simulated statistics this near the observed one tie with it: sums in another order differ by less.
TIE = 1e-9


def eb_standardize(t: DataFrame) -> DataFrame:
    """Add z and smoothed (shrunk ratio) to observed, expected, null_var."""
    r = F.col("observed") / F.col("expected")
    tot = t.agg(F.sum("observed").alias("_o"), F.sum("expected").alias("_e"))
    a = t.transform(attach, (tot)).withColumn("_b", F.col("_o") / F.col("_e")).withColumn("_r", r)
    a = (a.withColumn("_w", F.col("expected") / F.col("_e"))
         .withColumn("_samp", F.col("null_var") / F.pow("expected", 2)))
    mom = a.agg(F.greatest(F.lit(0.0), F.sum(F.col("_w") * F.pow(F.col("_r") - F.col("_b"), 2))
                           - F.sum(F.col("_w") * F.col("_samp"))).alias("_a"))
    a = a.transform(attach, (mom))
    dev, var = F.col("_r") - F.col("_b"), F.col("_a") + F.col("_samp")
    return (a.withColumn("z", dev / F.sqrt(F.nullif(var, F.lit(0.0))))
            .withColumn("smoothed", F.col("_b") + F.when(var > 0, F.col("_a") / var).otherwise(0.0) * dev)
            .drop("_o", "_e", "_b", "_r", "_w", "_samp", "_a"))


def spatial_lag(areas: DataFrame, nb: DataFrame, value: str, out: str = "lag") -> DataFrame:
    """Mean of the neighbours' values. ``areas``: id, value; ``nb``: i, j."""
    m = (nb.join(areas.select(F.col("id").alias("j"), F.col(value).alias("_v")), "j")
         .groupBy(F.col("i").alias("id")).agg(F.avg("_v").alias(out), F.count(F.lit(1)).alias("neighbors")))
    return areas.join(m, "id", "left")


def _centred(areas: DataFrame, value: str) -> DataFrame:
    mean = areas.agg(F.avg(value).alias("_mean"))
    return areas.select("id", value).transform(attach, (mean)).select("id", (F.col(value) - F.col("_mean")).alias("z"))


def _orders(z: DataFrame, nsim: int, seed: int, kind: str) -> DataFrame:
    """r, id, z, place (1..n), upto (sum of z up to the place): the areas of each simulation in random order."""
    o = z.select("id", "z", F.explode(F.sequence(F.lit(1), F.lit(nsim))).alias("r")).repartition("r")
    o = o.withColumn("key", F.md5(F.concat_ws(":", F.lit(f"{kind}:{seed}"), "r", F.col("id").cast("string"))))
    w = Window.partitionBy("r").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, 0)
    return o.withColumn("place", F.count(F.lit(1)).over(w)).withColumn("upto", F.sum("z").over(w)).drop("key")


def moran_global(areas: DataFrame, nb: DataFrame, value: str, nsim: int = 9999, seed: int = SEED) -> DataFrame:
    """One row: Moran's I, its analytic mean and sd under randomisation, z and permutation p."""
    areas, nb = cut_lineage(areas), cut_lineage(nb)
    z = _centred(areas, value)
    lagged = spatial_lag(z, nb, "z")
    sums = lagged.agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col("z") * F.col("lag")).alias("zl"),
                      F.sum(F.pow("z", 2)).alias("z2"), F.sum(F.pow("z", 4)).alias("z4"),
                      F.avg("neighbors").alias("mean_neighbors"))
    w = nb.join(nb.groupBy("i").agg((1.0 / F.count(F.lit(1))).alias("w")), "i")
    back = w.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("w").alias("v"))
    pairs = w.join(back, ["i", "j"], "full")
    s1 = pairs.agg((F.sum(F.pow(F.coalesce("w", F.lit(0.0)) + F.coalesce("v", F.lit(0.0)), 2)) / 2).alias("s1"))
    s0 = w.agg(F.sum("w").alias("s0"))
    row = w.groupBy(F.col("i").alias("id")).agg(F.sum("w").alias("a"))
    col = w.groupBy(F.col("j").alias("id")).agg(F.sum("w").alias("a"))
    s2 = (row.unionByName(col).groupBy("id").agg(F.pow(F.sum("a"), 2).alias("q")).agg(F.sum("q").alias("s2")))
    m = sums.transform(attach, (s0)).transform(attach, (s1)).transform(attach, (s2))
    some = lambda c: F.nullif(c, F.lit(0.0))  # noqa: E731  too few or equal areas have no statistic
    n, k = F.col("n"), F.col("n") * F.col("z4") / some(F.pow("z2", 2))
    ei = -1.0 / some(n - 1)
    first = n * ((n * n - 3 * n + 3) * F.col("s1") - n * F.col("s2") + 3 * F.pow("s0", 2))
    second = k * ((n * n - n) * F.col("s1") - 2 * n * F.col("s2") + 6 * F.pow("s0", 2))
    var = (first - second) / some((n - 1) * (n - 2) * (n - 3) * F.pow("s0", 2)) - ei * ei
    m = m.withColumn("moran_i", F.col("zl") / some(F.col("z2"))).withColumn("expected", ei).withColumn("sd", F.sqrt(var))

    # Simulations: an area gets the value of the area at its place in a second order.
    given = (_orders(z, nsim, seed, "a").select("r", "place", "id").join(_orders(z, nsim, seed, "b").select("r", "place", "z"), ["r", "place"]))
    given = given.select("r", "id", "z")
    pairs = (given.join(w.select(F.col("i").alias("id"), "j", "w"), "id").select("r", F.col("j").alias("id"), F.col("z").alias("zi"), "w")
             .join(given, ["r", "id"]).groupBy("r").agg(F.sum(F.col("zi") * F.col("z") * F.col("w")).alias("s")))
    hits = pairs.transform(attach, m.select("moran_i", "z2")).agg(F.count_if(F.col("s") / some(F.col("z2")) >= F.col("moran_i") - TIE).alias("h"))
    return m.transform(attach, hits).select(
        "moran_i", "expected", "sd", ((F.col("moran_i") - F.col("expected")) / some(F.col("sd"))).alias("z"),
        ((F.col("h") + 1) / (nsim + 1.0)).alias("p_perm"), F.lit(nsim).alias("nsim"),
        n.cast("bigint").alias("n"), "mean_neighbors")


#: Ranges of p-values that are adjusted side by side.
RANGES = 256


def bh_adjust(df: DataFrame, p: str, out: str = "q", within: list[str] = (), ranges: int = RANGES) -> DataFrame:
    """Benjamini-Hochberg over one row per area: the least p m / rank from the largest p down.

    Equal p-values are one row. The rest is cut into ranges of about equal size: ranks are running counts carried from
    range to range, and the least value from above is each range's own minimum carried down.
    """
    within = list(within)
    given = df.where(F.col(p).isNotNull()).select(*within, F.col(p).cast("double").alias("_p"))
    cuts = given.agg(F.percentile_approx("_p", [k / ranges for k in range(1, ranges)], 20 * ranges).alias("cuts"))
    v = given.groupBy(*within, "_p").agg(F.count("*").alias("_c")).transform(attach, cuts)
    v = cut_lineage(v.withColumn("_range", F.size(F.filter(F.coalesce("cuts", F.array().cast("array<double>")), lambda c: c <= F.col("_p")))).drop("cuts").withColumn("_all", F.lit(0)))
    key = ["_all", *within]
    total = v.groupBy(*key).agg(F.sum("_c").alias("_m"))
    v = ordered(v, key, "_range", ["_p"], running=["_c"]).join(total, key).withColumn("_adj", F.col("_p") * F.col("_m") / F.col("run__c"))
    above = Window.partitionBy(*key).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = v.groupBy(*key, "_range").agg(F.min("_adj").alias("_own")).withColumn("_above", F.min("_own").over(above)).drop("_own")
    here = F.min("_adj").over(Window.partitionBy(*key, "_range").orderBy(F.desc("_p")).rowsBetween(Window.unboundedPreceding, 0))
    v = v.withColumn("_here", here).join(carried, [*key, "_range"]).select(*within, "_p", F.least(F.lit(1.0), "_here", "_above").alias(out))
    return df.withColumn("_p", F.col(p).cast("double")).join(v, [*within, "_p"], "left").drop("_p")


#: Simulations that one block of rows stands for before they are drawn.
BLOCK_SIMULATIONS = 500


def first_places(z: DataFrame, places: int, nsim: int, seed: int, kind: str) -> DataFrame:
    """r, firsts: the first ``places`` areas (key, id, z) of each simulation's random order.

    Keys are spread evenly, so only those below a bound that lets about twice the places through are gathered. The few
    simulations that are left short are drawn once more without the bound.
    """
    n = z.count()
    places = min(places, n)
    blocks = z.select("id", "z", F.explode(F.sequence(F.lit(0), F.lit((nsim - 1) // BLOCK_SIMULATIONS))).alias("b")).repartition("b")
    drawn = blocks.withColumn("r", F.explode(F.sequence(F.col("b") * BLOCK_SIMULATIONS + 1, F.least((F.col("b") + 1) * BLOCK_SIMULATIONS, F.lit(nsim)))))
    keyed = drawn.select("r", "id", "z", F.md5(F.concat_ws(":", F.lit(f"{kind}:{seed}"), "r", F.col("id").cast("string"))).alias("key"))
    gather = lambda d: d.groupBy("r").agg(F.slice(F.array_sort(F.collect_list(F.struct("key", "id", "z"))), 1, places).alias("firsts"))
    share = (2 * places + 12) / max(n, 1)
    if share >= 1:
        return gather(keyed)
    near = cut_lineage(gather(keyed.where(F.col("key") < f"{int(share * 16**8):08x}")))
    full = near.where(F.size("firsts") >= places)
    short = z.sparkSession.range(1, nsim + 1).select(F.col("id").cast("int").alias("r")).join(full.select("r"), "r", "left_anti")
    return full.unionByName(gather(keyed.join(small_side(short), "r")))


def lisa(areas: DataFrame, nb: DataFrame, value: str, nsim: int = 99999, seed: int = SEED, alpha: float = 0.05) -> DataFrame:
    """Local Moran per area: ii, lag, z, p (conditional permutation), q, quadrant, class.

    In each simulation an area's k neighbours are the first k other areas of one
    random order: k different areas, every set as likely. Their mean comes from
    the order's sum at k, or at k + 1 less the area's own value if that is among
    the first k. Only the first places of an order are ever gathered: each
    simulation counts for all areas with k neighbours by its sum at k, and for the
    k areas that it has among its first the count is put right.
    """
    areas, nb = cut_lineage(areas), cut_lineage(nb)
    z = cut_lineage(_centred(areas, value))
    base = spatial_lag(z, nb, "z").where("neighbors is not null")
    m2 = z.agg(F.avg(F.pow("z", 2)).alias("m2"))
    base = cut_lineage(base.transform(attach, m2).withColumn("ii", F.col("z") * F.col("lag") / F.nullif(F.col("m2"), F.lit(0.0))))
    most = base.agg(F.max("neighbors")).first()[0] or 0
    firsts = first_places(z.where("z is not null"), most + 1, nsim, seed, "l")
    sums = F.aggregate("firsts", F.array(F.lit(0.0)), lambda acc, a: F.concat(acc, F.array(F.element_at(acc, -1) + a["z"])))
    ks = base.agg(F.collect_set("neighbors").alias("ks"))
    sims = firsts.withColumn("sums", sums).transform(attach, ks).select("firsts", "sums", F.explode("ks").alias("k"))
    at_k = F.get("sums", F.col("k").cast("int"))
    mine = base.select("id", F.col("z").alias("own"), "m2", "ii", F.col("neighbors").alias("k"))
    everywhere = sims.select("k", at_k.alias("drawn"), F.lit(1).alias("sign")).join(small_side(mine), "k")
    among = sims.select("k", at_k.alias("with"), F.get("sums", F.col("k").cast("int") + 1).alias("next"), F.explode(F.slice("firsts", F.lit(1), F.col("k").cast("int"))).alias("a"))
    among = among.withColumn("id", F.col("a.id")).join(small_side(mine), ["k", "id"])
    among = among.select(*mine.columns, F.inline(F.array(F.struct(F.col("with").alias("drawn"), F.lit(-1).alias("sign")), F.struct((F.col("next") - F.col("own")).alias("drawn"), F.lit(1).alias("sign")))))
    sim = F.col("own") * F.col("drawn") / F.col("k") / F.nullif(F.col("m2"), F.lit(0.0))
    counted = everywhere.select(*among.columns).unionByName(among).groupBy("id").agg(
        F.sum(F.when(sim <= F.col("ii") + TIE, F.col("sign")).otherwise(0)).alias("lo"), F.sum(F.when(sim >= F.col("ii") - TIE, F.col("sign")).otherwise(0)).alias("hi"))
    p = counted.select("id", F.least(F.lit(1.0), 2 * (F.least("lo", "hi") + 1) / (nsim + 1.0)).alias("p"))
    out = bh_adjust(cut_lineage(base.join(p, "id")), "p")
    quad = quadrant(F.col("z"), F.col("lag"))
    cls = (F.when(F.col("q") < alpha, quad).when(F.col("p") < alpha, F.concat(quad, F.lit("_unadj"))).otherwise("ns"))
    return out.select("id", "ii", "lag", "z", "p", "q", quad.alias("quadrant"), cls.alias("class"))


def quadrant(z, lag):
    return (F.when((z > 0) & (lag > 0), "HH").when((z < 0) & (lag < 0), "LL").when(z > 0, "HL").otherwise("LH"))
