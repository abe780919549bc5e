"""Random forest kept as a table: a row is a node, learned by aggregates and scored in one narrow pass.

Values are cut into ``bins`` equal parts of their dimension's range in the training rows. All
trees grow together, a level at a time: one aggregate counts the classes by (tree, node,
dimension, bin), and every node takes the cut of least Gini impurity. Only these counts are
shuffled (trees x nodes x dimensions x bins, whatever the number of rows), and only the chosen
cuts, at most ``trees x 2^depth``, reach the driver.

Draws are integer arithmetic on the row's id and the tree's number: a row takes part 0 to 3
times, a tree sees one of ``slices`` shares of the dimensions. Class weights make both classes
weigh the same. Counts are whole numbers and ties go to the smaller dimension and cut, so the
forest is the same for any partitioning, and SQL can grow it too.

Defined results: rows without label, id or vector teach nothing; rows without vector score
null; a value that is null or not a number lies in bin 0 and one outside the trained range in the
nearest bin; with fewer than two classes every leaf holds the share of positives (no rows: the
forest is empty and scores null). A saved forest is read back by ``load_forest``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

TREES, DEPTH, BINS, SLICES, MIN_ROWS = 16, 3, 16, 4, 5
A, B, M = 7919, 104729, 10007  # fixed values of the draw
MICRO = 1_000_000  # leaf probabilities are kept in millionths, so that sums over trees are exact

SCHEMA = "tree int, node int, dim int, cut int, lo double, hi double, rows long, micros long"


def _draws(tree) -> Column:
    """How often a row takes part in a tree: 0, 1, 2 or 3 times, once on average."""
    h = (F.col("id") * A + tree * B) % M
    return F.when(h < 3680, 0).when(h < 7360, 1).when(h < 9200, 2).otherwise(3).cast("long")


def _sees(dim, tree, slices: int) -> Column:
    return (dim * (2 * F.floor(tree / slices).cast("int") + 1) + tree) % slices == 0


def _bin(value, lo, hi, bins: int) -> Column:
    at = F.floor((value - lo) * bins / (hi - lo))
    return F.when((hi > lo) & value.isNotNull() & ~F.isnan(value), F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1))).otherwise(0).cast("int")


def fit_forest(df: DataFrame, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, slices: int = SLICES,
               min_rows: int = MIN_ROWS) -> DataFrame:
    """The forest of the rows (id, x array<double>, y 0/1) as a table of ``SCHEMA``.

    ``node`` counts from 1 (root); node n's children are 2n (bin of ``dim`` <= ``cut``) and
    2n + 1. A leaf has no ``dim``; ``micros`` is its share of positives, classes weighing the same.
    """
    spark = df.sparkSession
    known = df.where("id IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL").select("id", "x", "y")
    usable = F.when(F.abs("v") < float("inf"), F.col("v"))
    ranges = (known.select(F.posexplode("x").alias("d", "v")).groupBy("d").agg(F.min(usable).alias("lo"), F.max(usable).alias("hi"))
              .orderBy("d").collect())  # one row per dimension
    classes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = float(classes.get(0, 0)), float(classes.get(1, 0))
    if not classes:
        return spark.createDataFrame([], SCHEMA)
    one_class = not (n0 and n1)
    # positives weigh n0 and negatives n1, so that both classes weigh n0 * n1
    up, down = (1.0, 1.0) if one_class else (n0, n1)
    lo, hi = (F.array(*[F.lit(r[k]).cast("double") for r in ranges]).cast("array<double>") for k in ("lo", "hi"))

    binned = F.transform("x", lambda v, d: _bin(v, lo[d], hi[d], bins))
    tree = F.col("tree")
    rows = (known.select("id", "y", binned.alias("bins"), F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
            .withColumn("w", _draws(tree)).where("w > 0"))

    def reached(cuts: list) -> DataFrame:
        """Rows with the node that they have come to by the cuts found so far."""
        return rows.withColumn("node", _walk(cuts, trees, depth, F.col("bins"), tree))

    cuts: list[tuple] = []
    for level in range(depth):
        counts = (reached(cuts).where(F.col("node") >= 2 ** level)
                  .select("tree", "node", "y", "w", F.posexplode("bins").alias("dim", "bin"))
                  .where(_sees(F.col("dim"), tree, slices))
                  .groupBy("tree", "node", "dim", "bin").agg(F.sum(F.col("w") * F.col("y")).alias("a"), F.sum(F.col("w") * (1 - F.col("y"))).alias("b")))
        whole = Window.partitionBy("tree", "node", "dim")
        run = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        side = counts.select("tree", "node", "dim", "bin", *[F.sum(c).over(w).alias(c + k) for c in "ab" for w, k in ((run, "l"), (whole, "t"))])
        p, q = F.col("al").cast("double") * up, F.col("bl").cast("double") * down
        r, s = (F.col("at") - F.col("al")).cast("double") * up, (F.col("bt") - F.col("bl")).cast("double") * down
        allowed = side.where((F.col("al") + F.col("bl") >= min_rows) & (F.col("at") + F.col("bt") - F.col("al") - F.col("bl") >= min_rows)
                             & (F.col("at") > 0) & (F.col("bt") > 0))
        best = allowed.select("tree", "node", F.struct(((p * p + q * q) / (p + q) + (r * r + s * s) / (r + s)).alias("pure"),
                                                       (-F.col("dim")).alias("d"), (-F.col("bin")).alias("c")).alias("s"))
        found = best.groupBy("tree", "node").agg(F.max("s").alias("s")).collect()  # at most trees x 2^level rows
        if not found:
            break
        cuts += [(f["tree"], f["node"], -f["s"]["d"], -f["s"]["c"]) for f in found]

    ends = (reached(cuts).groupBy("tree", "node").agg(F.sum(F.col("w") * F.col("y")).alias("a"), F.sum(F.col("w") * (1 - F.col("y"))).alias("b"))
            .collect())  # at most trees x 2^depth rows
    out = [(t, n, d, c, ranges[d]["lo"], ranges[d]["hi"], None, None) for t, n, d, c in cuts]
    for e in ends:
        pos, neg = float(e["a"]) * up, float(e["b"]) * down
        out.append((e["tree"], e["node"], None, None, None, None, e["a"] + e["b"], int(pos / (pos + neg) * MICRO + 0.5)))
    return spark.createDataFrame(sorted(out, key=lambda r: r[:2]), SCHEMA)


def _walk(cuts: list, trees: int, depth: int, bins: Column, tree: Column) -> Column:
    """The node of ``tree`` where a row with these bins ends; ``cuts`` are (tree, node, dim, cut)."""
    size = 2 ** depth
    dims, at = [-1] * (trees * size), [0] * (trees * size)
    for t, n, d, c in cuts:
        dims[t * size + n], at[t * size + n] = d, c
    dims, at = (F.array(*[F.lit(v) for v in values]) for values in (dims, at))

    def down(node, _):
        place = tree * size + node
        inside = (node < size) & (F.get(dims, place) >= 0)
        return F.when(inside, 2 * node + F.when(F.get(bins, F.get(dims, place)) <= F.get(at, place), 0).otherwise(1)).otherwise(node)

    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(1), down)


def forest_probability(forest: DataFrame, x, bins: int = BINS) -> Column:
    """Mean leaf probability of the trees for the vector column ``x``.

    The forest (bounded by its trees and depth) becomes literals of the expression: rows are
    scored where they lie, without a join or a shuffle. ``bins`` is that of the fit.
    """
    rows = forest.collect()  # at most trees x 2^(depth + 1) rows
    if not rows:
        return F.lit(None).cast("double")
    trees = max(r["tree"] for r in rows) + 1
    depth = max(max(r["node"] for r in rows).bit_length() - 1, 1)
    cuts = [(r["tree"], r["node"], r["dim"], r["cut"]) for r in rows if r["dim"] is not None]
    leaves = [0] * (trees * 2 ** (depth + 1))
    for r in rows:
        if r["dim"] is None:
            leaves[r["tree"] * 2 ** (depth + 1) + r["node"]] = r["micros"]
    used = {r["dim"]: (r["lo"], r["hi"]) for r in rows if r["dim"] is not None}
    x = F.col(x) if isinstance(x, str) else x
    at = F.array(*[_bin(F.get(x, F.lit(d)), F.lit(used[d][0]), F.lit(used[d][1]), bins) if d in used else F.lit(0)
                   for d in range(max(used, default=0) + 1)])
    leaves = F.array(*[F.lit(v).cast("long") for v in leaves])
    total = F.aggregate(F.sequence(F.lit(0), F.lit(trees - 1)), F.lit(0).cast("long"),
                        lambda s, t: s + F.get(leaves, t * 2 ** (depth + 1) + _walk(cuts, trees, depth, at, t)))
    return F.when(x.isNotNull(), total.cast("double") / float(trees * MICRO))


def save_forest(forest: DataFrame, path: str) -> None:
    forest.coalesce(1).write.mode("overwrite").parquet(path)


def load_forest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)
