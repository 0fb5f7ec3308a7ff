"""Machine-learning queries on line items: predict the return flag."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lakeloom.operators import ml
from lakeloom.session import scratch_dir
from lakeloom.suite.base import query, table

CATEGORIES = ["l_linestatus"]
NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "ship_month"]


def labelled(spark, sf):
    """Line items with a 0/1 label (returned) and the features."""
    return table(spark, sf, "lineitem").select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey").alias("row_key"),
        (F.col("l_returnflag") == "R").cast("double").alias("label"),
        "l_linestatus", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        F.month("l_shipdate").alias("ship_month"), (F.col("l_orderkey") % 10).alias("tenth"),
    )


def parts(spark, sf):
    """Rows to learn from and rows to score: two tenths of the orders."""
    rows = labelled(spark, sf)
    return rows.where("tenth < 8"), rows.where("tenth >= 8")


SCORED = "(SELECT *, CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM lineitem WHERE l_orderkey % 10 >= 8)"


@query("M01_vector_assembler", """SELECT l_linenumber, count(*) AS n, round(sum(l_quantity), 2) AS s0, round(sum(l_discount), 2) AS s1
    FROM lineitem GROUP BY l_linenumber""")
def vector_assembler(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_linenumber", "l_quantity", "l_discount")
    vectors = VectorAssembler(inputCols=["l_quantity", "l_discount"], outputCol="features").transform(rows)
    parts = vectors.select("l_linenumber", vector_to_array("features").alias("f"))
    return parts.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.round(F.sum(F.col("f")[0]), 2).alias("s0"), F.round(F.sum(F.col("f")[1]), 2).alias("s1")
    )


@query("M02_string_indexer", """SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx,
    count(*) AS n FROM orders GROUP BY o_orderpriority""")
def string_indexer(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority")
    indexed = StringIndexer(inputCol="o_orderpriority", outputCol="idx").fit(orders).transform(orders)
    return indexed.groupBy("o_orderpriority", "idx").agg(F.count("*").alias("n"))


@query("M03_linear_regression", """SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, count(*) AS n FROM lineitem""")
def linear_regression(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    model = ml.linear_fit(lines, ["l_quantity"], "l_extendedprice")
    return lines.agg(
        F.round(F.lit(float(model.coefficients[0])), 3).alias("slope"),
        F.round(F.lit(float(model.intercept)), 2).alias("intercept"),
        F.count("*").alias("n"),
    )


MAX_DEPTH = 5


def _fitted(spark, sf):
    train, test = parts(spark, sf)
    return ml.tree_stages(CATEGORIES, NUMBERS, "label", max_depth=MAX_DEPTH).fit(train), test


@query("M04_decision_tree", f"""SELECT label, count(*) AS n, TRUE AS all_scored, TRUE AS within_depth, TRUE AS no_worse_than_majority
    FROM {SCORED} GROUP BY label""")
def decision_tree(spark, sf):
    model, test = _fitted(spark, sf)

    def per_label(rows):
        return model.transform(rows).groupBy("label").agg(
            F.count("*").alias("n"), F.count("prediction").alias("scored"), F.count_if(F.col("label") == F.col("prediction")).alias("hits"))

    # on the rows it learned from, a tree is right at least as often as the commonest label
    learned = per_label(parts(spark, sf)[0]).agg(F.sum("hits").alias("all_hits"), F.max("n").alias("majority"))
    return per_label(test).join(learned).select(  # one row of totals beside one row per label
        "label", "n", (F.col("scored") == F.col("n")).alias("all_scored"), F.lit(model.stages[-1].depth <= MAX_DEPTH).alias("within_depth"),
        (F.col("all_hits") >= F.col("majority")).alias("no_worse_than_majority"))


@query("M05_fitted_stages", f"""SELECT label, count(*) AS n, count(DISTINCT (l_orderkey, l_linenumber, l_partkey)) AS keys, TRUE AS same_as_stages, TRUE AS probabilities
    FROM {SCORED} GROUP BY label""")
def fitted_stages(spark, sf):
    model, test = _fitted(spark, sf)
    by_hand = test
    for stage in model.stages:
        by_hand = stage.transform(by_hand.withColumnRenamed("prediction", "before"))
    returned = vector_to_array("probability")[1]
    both = model.transform(test).select("row_key", "label", F.xxhash64("prediction", returned).alias("whole"), F.lit(0).alias("hand"), returned.alias("p")).unionByName(
        by_hand.select("row_key", "label", F.lit(0).cast("long").alias("whole"), F.xxhash64("prediction", returned).alias("hand"), F.lit(0.5).alias("p")))
    per_key = both.groupBy("label", "row_key").agg(
        (F.count("*") / 2).cast("long").alias("n"), F.sum(F.col("whole") % 1_000_003).alias("whole"), F.sum(F.col("hand") % 1_000_003).alias("hand"),
        F.min("p").alias("low"), F.max("p").alias("high"))
    return per_key.groupBy("label").agg(
        F.sum("n").alias("n"), F.count("*").alias("keys"), F.bool_and(F.col("whole") == F.col("hand")).alias("same_as_stages"),
        F.bool_and((F.col("low") >= 0) & (F.col("high") <= 1)).alias("probabilities"))


@query("M06_evaluate", f"""SELECT TRUE AS same_accuracy, TRUE AS same_weighted_precision, TRUE AS f1_in_range, count(*) AS n,
    count(*) FILTER (WHERE label = 1) AS n_returned FROM {SCORED}""")
def evaluate(spark, sf):
    model, test = _fitted(spark, sf)
    scored = model.transform(test).select("label", "prediction").cache()
    metrics = ml.evaluate(scored, "label", ["f1", "accuracy", "weightedPrecision"])
    cells = ml.confusion(scored, "label")
    per_class = cells.groupBy("prediction").agg(
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("count")).otherwise(0)).alias("hits"),
        F.sum("count").alias("predicted"),
    )
    actual = cells.groupBy(F.col("label").alias("prediction")).agg(F.sum("count").alias("actual"))
    sums = (
        actual.join(per_class, "prediction", "left").na.fill(0)
        .agg(
            F.sum("hits").alias("hits"), F.sum("actual").alias("n"),
            F.sum(F.when(F.col("prediction") == 1, F.col("actual")).otherwise(0)).alias("n_returned"),
            F.sum(F.when(F.col("predicted") > 0, F.col("actual") * F.col("hits") / F.col("predicted")).otherwise(0)).alias("wp"),
        )
    )
    result = sums.select(
        (F.abs(F.col("hits") / F.col("n") - metrics["accuracy"]) < 1e-9).alias("same_accuracy"),
        (F.abs(F.col("wp") / F.col("n") - metrics["weightedPrecision"]) < 1e-9).alias("same_weighted_precision"),
        F.lit(0 < metrics["f1"] <= 1).alias("f1_in_range"), "n", "n_returned",
    )
    answer = spark.createDataFrame(result.collect(), result.schema)  # one row; the scored rows are let go
    scored.unpersist()
    return answer


@query("M07_model_search", f"""SELECT max_depth, max_bins, TRUE AS valid, TRUE AS best_is_top, count(*) AS n_scored
    FROM (VALUES (2, 16), (2, 32), (4, 16), (4, 32)) AS s(max_depth, max_bins), {SCORED} GROUP BY ALL""")
def model_search(spark, sf):
    train, test = parts(spark, sf)
    train = train.cache()
    found = ml.search(train, ml.tree_stages(CATEGORIES, NUMBERS, "label"), "label", depths=[2, 4], bins=[16, 32])
    train.unpersist()
    top = max(found.validationMetrics)
    settings = []
    for params, metric in zip(found.getEstimatorParamMaps(), found.validationMetrics):
        values = {p.name: v for p, v in params.items()}
        settings.append((values["maxDepth"], values["maxBins"], metric))
    best = found.bestModel.stages[-1]
    is_top = (best.getMaxDepth(), best.getMaxBins(), top) in settings
    tried = spark.createDataFrame(settings, "max_depth int, max_bins int, f1 double")
    scored = found.bestModel.transform(test).agg(F.count("prediction").alias("n_scored"))
    return spark.sql(
        """SELECT max_depth, max_bins, f1 > 0 AND f1 <= 1 AS valid, :is_top AS best_is_top,
                  (SELECT n_scored FROM {scored}) AS n_scored FROM {tried}""",
        args={"is_top": is_top}, tried=tried, scored=scored,
    )


@query("M08_save_and_reload", f"SELECT count(*) AS n, TRUE AS same_scores FROM {SCORED}")
def save_and_reload(spark, sf):
    model, test = _fitted(spark, sf)
    again = ml.save_and_reload(model, scratch_dir(spark, "model"))

    def totals(fitted, tag):
        return fitted.transform(test).agg(
            F.count("*").alias(f"n_{tag}"),
            F.sum(F.xxhash64("row_key", "prediction") % 1_000_003).alias(f"h_{tag}"),
        )

    return spark.sql(
        """SELECT (SELECT n_a FROM {a}) AS n, (SELECT n_a FROM {a}) = (SELECT n_b FROM {b}) AND (SELECT h_a FROM {a}) = (SELECT h_b FROM {b}) AS same_scores""",
        a=totals(model, "a"), b=totals(again, "b"),
    )
