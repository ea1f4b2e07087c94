"""Features, trees, clusters and text classification."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyforge.catalog import fixtures as fx
from tallyforge.catalog.registry import query, rounded, table
from tallyforge.functions.vectors import euclidean
from tallyforge.operators import clustering, counting, features, mail, trees
from tallyforge.operators.sampling import sample_by_hash, split_by_hash
from tallyforge.plans.durable import materialize, new_folder
from tallyforge.sources.text import scan_text

_C = f"c AS ({fx.COVER})"
_KEYS = ("l_orderkey", "l_linenumber")


def cover_values(spark, folder):
    return fx.with_values(fx.fixture(spark, folder, fx.COVER), keep=_KEYS)


@query("features_label", f"""
WITH {_C}, cells AS (
  SELECT l_orderkey, l_linenumber, label - 1 AS label,
         n0 + n1 + n2 + n3 + n4 + n5 + n6 + n7 + n8 + n9 AS numbers,
         CASE WHEN wilderness >= 0 THEN 10 + wilderness ELSE 0 END + 14 + soil AS places FROM c)
SELECT l_orderkey, l_linenumber, label, 54 AS width, round(numbers, 4) AS numbers, places::DOUBLE AS places FROM cells""")
def features_label(spark, folder):
    rows = features.features_label(cover_values(spark, folder), keep=_KEYS)
    numbers = F.aggregate(F.slice("features", 1, 10), F.lit(0.0), lambda a, x: a + x)
    places = F.aggregate(
        F.transform(F.slice("features", 11, 44), lambda x, i: x * (i + 10)), F.lit(0.0), lambda a, x: a + x
    )
    return rows.select(
        *_KEYS, "label", F.size("features").alias("width"), rounded(numbers, 4).alias("numbers"), places.alias("places")
    )


@query("unencode_onehot", f"""
WITH {_C} SELECT l_orderkey, l_linenumber, label - 1 AS label, 12 AS width, n0, n9, wilderness::DOUBLE AS wilderness,
soil::DOUBLE AS soil FROM c""")
def unencode_onehot(spark, folder):
    rows = features.unencode_onehot(cover_values(spark, folder), keep=_KEYS)
    at = F.col("features").getItem
    return rows.select(
        *_KEYS, "label", F.size("features").alias("width"), at(0).alias("n0"), at(9).alias("n9"),
        at(10).alias("wilderness"), at(11).alias("soil"),
    )


_N = f"n AS ({fx.NETWORK})"
_NETWORK_KEYS = ("l_orderkey", "l_linenumber", "label")


def network(spark, folder):
    return fx.fixture(spark, folder, fx.NETWORK)


def encoded(spark, folder):
    return features.onehot_encode(
        network(spark, folder), fx.NETWORK_NUMBERS, fx.NETWORK_CATEGORIES, keep=_NETWORK_KEYS
    )


def _codes(columns):
    return ", ".join(
        f"d{i} AS (SELECT {c} AS v, row_number() OVER (ORDER BY {c}) AS p, count(*) OVER () AS w FROM (SELECT DISTINCT {c} FROM n))"
        for i, c in enumerate(columns, start=1)
    )


@query("onehot_encode", f"""
WITH {_N}, {_codes(fx.NETWORK_CATEGORIES)}
SELECT l_orderkey, l_linenumber, label, (5 + d1.w + d2.w + d3.w)::INT AS width, d1.p::DOUBLE AS place_1,
       (d1.w + d2.p)::DOUBLE AS place_2, (d1.w + d2.w + d3.p)::DOUBLE AS place_3, c0 AS first, c6 AS last_but_one
FROM n JOIN d1 ON c1 = d1.v JOIN d2 ON c2 = d2.v JOIN d3 ON c3 = d3.v""")
def onehot_encode(spark, folder):
    rows = encoded(spark, folder)
    blocks = F.slice("features", 2, F.size("features") - 5)
    places = F.filter(
        F.transform(blocks, lambda x, i: F.when(x == 1.0, (i + 1).cast("double"))), lambda p: p.isNotNull()
    )
    return rows.select(
        *_NETWORK_KEYS, F.size("features").alias("width"),
        *[places.getItem(i).alias(f"place_{i + 1}") for i in range(3)],
        F.col("features").getItem(0).alias("first"), F.element_at("features", -2).alias("last_but_one"),
    )


@query("drop_categorical", f"WITH {_N} SELECT l_orderkey, l_linenumber, label, c0, c4, c5, c6, c7_constant FROM n")
def drop_categorical(spark, folder):
    return features.drop_categorical(network(spark, folder), fx.NETWORK_NUMBERS, keep=_NETWORK_KEYS)


_Z = ", ".join(
    f"round(CASE WHEN stddev_pop({c}) OVER () > 0 THEN ({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () "
    f"ELSE {c} - avg({c}) OVER () END, 6) + 0.0 AS {c}"
    for c in fx.NETWORK_NUMBERS
)


@query("zscore", f"WITH {_N} SELECT l_orderkey, l_linenumber, {_Z} FROM n")
def zscore(spark, folder):
    normal = features.zscore(
        features.drop_categorical(network(spark, folder), fx.NETWORK_NUMBERS, keep=_KEYS), fx.NETWORK_NUMBERS
    )
    return normal.select(*_KEYS, *[rounded(c).alias(c) for c in fx.NETWORK_NUMBERS])


@query("class_priors", f"""
WITH {_N} SELECT label, round(count(*) / (SELECT count(*) FROM n), 6) AS prior FROM n GROUP BY label""")
def class_priors(spark, folder):
    return trees.class_priors(network(spark, folder)).withColumn("prior", rounded("prior"))


_BUCKET = "((l_orderkey + 3) % 1000003 * 7919 + 104729) % 1000003 % 10000"


@query("random_guess_accuracy", f"""
WITH {_N}, s AS (SELECT label, {_BUCKET} < 9000 AS train FROM n),
a AS (SELECT label, count(*) / (SELECT count(*) FROM s WHERE train) AS p FROM s WHERE train GROUP BY 1),
b AS (SELECT label, count(*) / (SELECT count(*) FROM s WHERE NOT train) AS q FROM s WHERE NOT train GROUP BY 1)
SELECT round(sum(p * q), 6) AS accuracy FROM a JOIN b USING (label)""")
def random_guess_accuracy(spark, folder):
    train, test = split_by_hash(network(spark, folder), "l_orderkey", (0.9, 0.1), seed=3)
    return trees.random_guess_accuracy(train, test).withColumn("accuracy", rounded("accuracy"))


# Predictions by a plain rule, so that SQL can repeat them.
_SAID = f"{_C}, said AS (SELECT label - 1 AS label, (n4 + l_linenumber) % 7 AS prediction FROM c)"


def said(spark, folder):
    cover = fx.fixture(spark, folder, fx.COVER)
    return cover.select((F.col("label") - 1).alias("label"), ((F.col("n4") + F.col("l_linenumber")) % 7).alias("prediction"))


@query("confusion_matrix", f"WITH {_SAID} SELECT label, prediction, count(*) AS cnt FROM said GROUP BY 1, 2")
def confusion_matrix(spark, folder):
    return trees.confusion_matrix(said(spark, folder))


@query("accuracy", f"WITH {_SAID} SELECT round(avg((label = prediction)::INT), 6) AS accuracy FROM said")
def accuracy(spark, folder):
    return trees.accuracy(said(spark, folder)).withColumn("accuracy", rounded("accuracy"))


@query("per_class_precision_recall", f"""
WITH {_SAID}, classes AS (SELECT label AS class FROM said UNION SELECT prediction FROM said)
SELECT class, round(count(*) FILTER (label = class AND prediction = class)
                    / nullif(count(*) FILTER (prediction = class), 0), 6) AS precision,
       round(count(*) FILTER (label = class AND prediction = class) / nullif(count(*) FILTER (label = class), 0), 6) AS recall
FROM said, classes GROUP BY class""")
def per_class_precision_recall(spark, folder):
    measures = trees.per_class_precision_recall(said(spark, folder))
    return measures.select("class", rounded("precision").alias("precision"), rounded("recall").alias("recall"))


def tree_parts(spark, folder, coded=False):
    rows = cover_values(spark, folder)
    rows = features.unencode_onehot(rows, keep=_KEYS) if coded else features.features_label(rows, keep=_KEYS)
    if coded:  # a missing code is no category: it goes to a place of its own behind the others
        rows = rows.withColumn("features", F.concat(
            F.slice("features", 1, 10), F.transform(F.slice("features", 11, 1), lambda x: F.when(x < 0, 4.0).otherwise(x)),
            F.slice("features", 12, 1),
        ))
    rows = features.as_vector(rows.where("label IS NOT NULL"))
    return split_by_hash(rows, "l_orderkey", (0.8, 0.1, 0.1), seed=3)


@query("decision_tree")
def decision_tree(spark, folder):
    train, check, _ = tree_parts(spark, folder)
    return trees.confusion_matrix(trees.decision_tree(train).transform(check))


@query("tree_grid")
def tree_grid(spark, folder):
    return trees.tree_grid(*tree_parts(spark, folder))


_CODED = {10: 5, 11: 40}


@query("tree_grid_categorical")
def tree_grid_categorical(spark, folder):
    return trees.tree_grid_categorical(*tree_parts(spark, folder, coded=True), categories=_CODED)


@query("random_forest")
def random_forest(spark, folder):
    train, check, _ = (trees.declare_nominal(p, 12, _CODED) for p in tree_parts(spark, folder, coded=True))
    model = trees.random_forest(train)
    return trees.accuracy(model.transform(check))


@query("sort_by_metric", f"""
WITH {_N} SELECT c3 AS kind, round(avg(c4), 4) AS metric FROM n GROUP BY 1 ORDER BY metric DESC, kind""")
def sort_by_metric(spark, folder):
    means = network(spark, folder).groupBy(F.col("c3").alias("kind")).agg(rounded(F.avg("c4"), 4).alias("metric"))
    return counting.sort_by_metric(means, "metric", ["kind"])


_DIST = "sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda p: (p[1]::DOUBLE - p[2]::DOUBLE) ^ 2)))"
_ASSIGNED = f"""d AS (
SELECT a.vec_id, a.label, b.vec_id::INT AS cluster, {_DIST} AS distance
FROM embeddings a, (SELECT * FROM embeddings WHERE vec_id < 10) b),
assigned AS (SELECT vec_id, label, arg_min(cluster, distance) AS cluster, min(distance) AS distance FROM d GROUP BY ALL)"""


def assigned(spark, folder):
    return clustering.kmeans_assign(fx.vectors(spark, folder), fx.centroids(spark, folder))


@query("vector_distance", f"""
SELECT a.vec_id, round({_DIST}, 6) AS distance FROM embeddings a JOIN embeddings b ON b.vec_id = a.label""")
def vector_distance(spark, folder):
    rows = fx.vectors(spark, folder)
    centres = fx.centroids(spark, folder).withColumnRenamed("cluster", "label")
    return rows.join(centres, "label").select("vec_id", rounded(euclidean("features", "centre")).alias("distance"))


@query("kmeans_assign", f"WITH {_ASSIGNED} SELECT vec_id, cluster, round(distance, 6) AS distance FROM assigned")
def kmeans_assign(spark, folder):
    return assigned(spark, folder).select("vec_id", "cluster", rounded("distance").alias("distance"))


@query("mean_distance", f"WITH {_ASSIGNED} SELECT round(avg(distance), 6) AS mean_distance FROM assigned")
def mean_distance(spark, folder):
    return clustering.mean_distance(assigned(spark, folder)).withColumn("mean_distance", rounded("mean_distance"))


@query("cluster_label_contingency", f"WITH {_ASSIGNED} SELECT cluster, label, count(*) AS cnt FROM assigned GROUP BY 1, 2")
def cluster_label_contingency(spark, folder):
    return clustering.cluster_label_contingency(assigned(spark, folder))


_CELLS = f"""{_ASSIGNED}, cells AS (SELECT cluster, label, count(*) AS c FROM assigned GROUP BY 1, 2),
e AS (SELECT cluster, sum(c) AS total, sum(-(c / t) * ln(c / t)) AS entropy
      FROM (SELECT *, sum(c) OVER (PARTITION BY cluster) AS t FROM cells) GROUP BY 1)"""


@query("entropy", f"WITH {_CELLS} SELECT cluster, total::BIGINT AS total, round(entropy, 6) + 0.0 AS entropy FROM e")
def entropy(spark, folder):
    cells = clustering.cluster_label_contingency(assigned(spark, folder))
    return clustering.entropy(cells, by=("cluster",)).withColumn("entropy", rounded("entropy"))


@query("weighted_cluster_entropy", f"WITH {_CELLS} SELECT round(sum(total * entropy) / sum(total), 6) AS weighted_entropy FROM e")
def weighted_cluster_entropy(spark, folder):
    result = clustering.weighted_cluster_entropy(assigned(spark, folder))
    return result.withColumn("weighted_entropy", rounded("weighted_entropy"))


@query("kmeans_anomalies_fixed", f"""
WITH {_ASSIGNED} SELECT vec_id, cluster, round(distance, 6) AS distance FROM assigned
WHERE distance > (SELECT min(distance) FROM (SELECT distance FROM assigned ORDER BY distance DESC LIMIT 100))""")
def kmeans_anomalies_fixed(spark, folder):
    far = clustering.beyond_threshold(assigned(spark, folder))
    return far.select("vec_id", "cluster", rounded("distance").alias("distance"))


_MATRIX = clustering.projection_matrix(64, 3, seed=1)
_AXES = ", ".join(
    "round(list_sum(list_transform(list_zip(embedding, [" + ", ".join(f"{v!r}::DOUBLE" for v in axis)
    + f"]), lambda p: p[1]::DOUBLE * p[2])), 6) + 0.0 AS x{i}"
    for i, axis in enumerate(_MATRIX, start=1)
)


@query("random_projection", f"SELECT vec_id, label, {_AXES} FROM embeddings")
def random_projection(spark, folder):
    rows = clustering.random_projection(fx.vectors(spark, folder), _MATRIX, keep=("vec_id", "label"))
    return rows.select("vec_id", "label", *[rounded(f"x{i}").alias(f"x{i}") for i in (1, 2, 3)])


@query("cluster_sample_export", f"""
WITH {_ASSIGNED} SELECT concat_ws(',', cluster, vec_id) AS head FROM assigned
WHERE ((vec_id + 7) % 1000003 * 7919 + 104729) % 1000003 % 10000 < 500""")
def cluster_sample_export(spark, folder):
    path = new_folder(spark, "cluster-sample")
    # The sample is the operator; it is drawn by hash here so that SQL can repeat it, and the id is put in front.
    rows = sample_by_hash(assigned(spark, folder), "vec_id", 0.05, seed=7)
    rows = rows.withColumn("features", F.concat(F.array(F.col("vec_id").cast("double")), F.col("features")))
    clustering.cluster_sample_export(rows, path, fraction=1.0)
    parts = F.split("value", ",")
    return scan_text(spark, path).select(
        F.concat_ws(",", parts[0], parts[1].cast("double").cast("bigint").cast("string")).alias("head")
    )


def network_features(spark, folder):
    rows = features.drop_categorical(network(spark, folder), fx.NETWORK_NUMBERS, keep=_NETWORK_KEYS)
    return rows.select(*_NETWORK_KEYS, F.array(*fx.NETWORK_NUMBERS).alias("features"))


@query("kmeans_fit")
def kmeans_fit(spark, folder):
    # The fit and the assignment both read these rows: they are joined once.
    rows = materialize(network_features(spark, folder).select("label", "features"), "network-features")
    model = clustering.kmeans_fit(rows, k=2)
    return clustering.cluster_label_contingency(clustering.kmeans_transform(model, rows))


@query("kmeans_sweep_distance")
def kmeans_sweep_distance(spark, folder):
    """The four sweeps: coarse from one start by the library's tolerance, then fine, normalised, and one-hot and normalised."""
    rows = network_features(spark, folder)
    coarse = clustering.kmeans_sweep_distance(rows, clustering.SWEEP_COARSE, starts=1, tol=1e-4)
    fine = clustering.kmeans_sweep_distance(rows, clustering.SWEEP_FINE)
    normal = clustering.kmeans_sweep_distance(rows, clustering.SWEEP_NORMAL, normalise=True)
    onehot = clustering.kmeans_sweep_distance(encoded(spark, folder), clustering.SWEEP_ONEHOT, normalise=True)
    named = [part.select(F.lit(name).alias("sweep"), "k", "mean_distance")
             for name, part in (("coarse", coarse), ("fine", fine), ("normal", normal), ("onehot", onehot))]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


@query("kmeans_sweep_entropy")
def kmeans_sweep_entropy(spark, folder):
    return clustering.kmeans_sweep_entropy(encoded(spark, folder))


@query("kmeans_anomalies")
def kmeans_anomalies(spark, folder):
    far = clustering.kmeans_anomalies(encoded(spark, folder))
    return far.select(*_NETWORK_KEYS, "cluster", "distance")


def messages(spark, folder):
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").cast("double").alias("label"))
    return fx.documents(spark, folder).join(labels, "doc_id")


@query("hashing_tf", """
SELECT doc_id, CASE WHEN length(text) > 0 AND rtrim(text, ' ') = '' THEN 0.0
                    ELSE len(string_split(rtrim(text, ' '), ' ')) END::DOUBLE AS words FROM documents""")
def hashing_tf(spark, folder):
    hashed = mail.hashing_tf(fx.documents(spark, folder))
    words = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", words.alias("words"))


@query("spam_classifier")
def spam_classifier(spark, folder):
    rows = messages(spark, folder)
    model = mail.spam_classifier(rows.select("text", "label"))
    return mail.classify(model, rows).select("doc_id", "label", "prediction")


@query("spam_sgd")
def spam_sgd(spark, folder):
    rows = messages(spark, folder)
    model = mail.spam_sgd(rows.select("text", "label"))
    return mail.classify_sgd(model, rows).select("doc_id", "label", "prediction")
