"""Vector functions over the embeddings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusml.functions import vectors as V
from corpusml.operators import matrices
from corpusml.queries.base import Catalog, places, sql_places, table

catalog = Catalog()

_E = "(SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS a FROM embeddings)"


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("a"))


def _entries(spark, sf_dir, vector: Column):
    """Long form, rounded: one row per vector and position."""
    rows = _vectors(spark, sf_dir).select("vec_id", F.posexplode(vector).alias("pos", "v"))
    return rows.select("vec_id", F.col("pos").cast("long").alias("pos"), places("v").alias("v"))


def _sql_entries(vector: str) -> str:
    return f"""
    SELECT vec_id, pos - 1 AS pos, {sql_places("x[pos]")} AS v
    FROM (SELECT vec_id, {vector} AS x, unnest(range(1, len(a) + 1)) AS pos FROM {_E})"""


@catalog.add(_sql_entries("list_transform(a, lambda v: greatest(v, 0.0))"))
def relu(spark, sf_dir):
    return _entries(spark, sf_dir, V.relu("a"))


@catalog.add(_sql_entries("list_transform(a, lambda v: 1.0 / (1.0 + exp(-v)))"))
def sigmoid(spark, sf_dir):
    return _entries(spark, sf_dir, V.sigmoid("a"))


@catalog.add(_sql_entries("list_transform(a, lambda v: 1.0 / (1.0 + exp(-least(20.0, greatest(-20.0, v * 1000)))))"))
def clamped_sigmoid(spark, sf_dir):
    return _entries(spark, sf_dir, F.transform("a", lambda v: V.logistic(v * 1000, 20.0)))


@catalog.add(_sql_entries("list_transform(a, lambda v: tanh(v))"))
def tanh(spark, sf_dir):
    return _entries(spark, sf_dir, V.tanh("a"))


@catalog.add(_sql_entries("list_transform(a, lambda v: v * v)"))
def vector_square(spark, sf_dir):
    return _entries(spark, sf_dir, V.square("a"))


@catalog.add(_sql_entries("list_transform(range(1, len(a) + 1), lambda i: a[i] + a[len(a) + 1 - i])"))
def vector_add(spark, sf_dir):
    return _entries(spark, sf_dir, V.add("a", F.reverse("a")))


@catalog.add(_sql_entries("list_transform(range(1, len(a) + 1), lambda i: a[i] - a[len(a) + 1 - i])"))
def vector_subtract(spark, sf_dir):
    return _entries(spark, sf_dir, V.subtract("a", F.reverse("a")))


@catalog.add(_sql_entries("list_transform(range(1, len(a) + 1), lambda i: a[i] * a[len(a) + 1 - i])"))
def hadamard(spark, sf_dir):
    return _entries(spark, sf_dir, V.hadamard("a", F.reverse("a")))


@catalog.add(_sql_entries("list_transform(a, lambda v: exp(v) / list_sum(list_transform(a, lambda w: exp(w))))"))
def softmax(spark, sf_dir):
    return _entries(spark, sf_dir, V.softmax("a"))


_SQL_LOSS = f"""
    SELECT vec_id, label, list_sum(list_transform(a, lambda v: exp(v))) AS total, a[label % 64 + 1] AS logit FROM {_E}"""


def _target() -> Column:
    place = F.pmod(F.col("label"), F.lit(64))
    return F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: (k == place).cast("double"))


@catalog.add(f"SELECT vec_id, {sql_places('ln(total) - logit')} AS loss FROM ({_SQL_LOSS})")
def cross_entropy(spark, sf_dir):
    loss = V.cross_entropy(V.softmax("a"), _target())
    return _vectors(spark, sf_dir).select("vec_id", places(loss).alias("loss"))


@catalog.add(f"SELECT {sql_places('avg(ln(total) - logit)')} AS loss FROM ({_SQL_LOSS})")
def mean_loss(spark, sf_dir):
    loss = V.cross_entropy(V.softmax("a"), _target())
    return _vectors(spark, sf_dir).agg(places(F.avg(loss)).alias("loss"))


@catalog.add(_sql_entries("""list_transform(range(1, len(a) + 1), lambda i:
    exp(a[i]) / list_sum(list_transform(a, lambda w: exp(w))) - CASE WHEN i = label % 64 + 1 THEN 1 ELSE 0 END)"""))
def softmax_cross_entropy_gradient(spark, sf_dir):
    return _entries(spark, sf_dir, V.softmax_cross_entropy_grad(F.lit(1.0), "a", _target()))


_SQL_CENTRES = f"""
    SELECT label, pos, avg(v) AS v
    FROM (SELECT label, unnest(range(0, len(a))) AS pos, unnest(a) AS v FROM {_E}) GROUP BY label, pos"""

_SQL_PRODUCT = f"""
    SELECT e.vec_id, c.label AS j, {sql_places("sum(e.v * c.v)")} AS v
    FROM (SELECT vec_id, unnest(range(0, len(a))) AS pos, unnest(a) AS v FROM {_E}) e
    JOIN ({_SQL_CENTRES}) c ON e.pos = c.pos GROUP BY e.vec_id, c.label"""


def _centres(spark, sf_dir):
    """Mean vector of every label in long form: ``(i, j, v)`` with position and label."""
    rows = _vectors(spark, sf_dir).select("label", F.posexplode("a").alias("pos", "v"))
    means = rows.groupBy("pos", "label").agg(F.avg("v").alias("v"))
    return means.select(F.col("pos").alias("i"), F.col("label").alias("j"), "v")


@catalog.add(_SQL_PRODUCT)
def matrix_product(spark, sf_dir):
    a = matrices.to_long(_vectors(spark, sf_dir), "vec_id", "a")
    cells = matrices.product(a, _centres(spark, sf_dir))
    return cells.select(F.col("i").alias("vec_id"), "j", places("v").alias("v"))


@catalog.add(_SQL_PRODUCT)
def matrix_product_small(spark, sf_dir):
    ordered = F.sort_array(F.collect_list(F.struct("i", "v")))["v"]
    columns = _centres(spark, sf_dir).groupBy("j").agg(ordered.alias("column"))
    labels = columns.agg(F.sort_array(F.collect_list("j")).alias("labels"))
    scored = matrices.times_small(_vectors(spark, sf_dir), "a", columns, "out")
    flat = scored.withColumn("labels", labels.scalar()).select(
        "vec_id", F.explode(F.arrays_zip("labels", "out")).alias("x")
    )
    return flat.select("vec_id", F.col("x.labels").alias("j"), places("x.out").alias("v"))


# derivatives: the incoming error is the reversed vector ---------------------------------------

def _sql_gradient(entry: str) -> str:
    return _sql_entries(f"list_transform(range(1, len(a) + 1), lambda i: a[len(a) + 1 - i] * ({entry}))")


@catalog.add(_sql_gradient("CASE WHEN a[i] > 0 THEN 1 ELSE 0 END"))
def relu_gradient(spark, sf_dir):
    return _entries(spark, sf_dir, V.relu_grad(F.reverse("a"), "a"))


@catalog.add(_sql_gradient("1 - tanh(a[i]) * tanh(a[i])"))
def tanh_gradient(spark, sf_dir):
    return _entries(spark, sf_dir, V.tanh_grad(F.reverse("a"), V.tanh("a")))


@catalog.add(_sql_gradient("1 / (1 + exp(-a[i])) * (1 - 1 / (1 + exp(-a[i])))"))
def sigmoid_gradient(spark, sf_dir):
    return _entries(spark, sf_dir, V.sigmoid_grad(F.reverse("a"), V.sigmoid("a")))


@catalog.add(_sql_gradient("2 * a[i]"))
def square_gradient(spark, sf_dir):
    return _entries(spark, sf_dir, V.square_grad(F.reverse("a"), "a"))


@catalog.add(_sql_gradient("a[i]"))
def hadamard_gradient(spark, sf_dir):
    """The error of one factor is the incoming error times the other factor."""
    return _entries(spark, sf_dir, V.hadamard(F.reverse("a"), "a"))


_SQL_CELLS = f"""
    x AS (SELECT vec_id, unnest(range(0, len(a))) AS pos, unnest(a) AS v FROM {_E}),
    w AS ({_SQL_CENTRES}),
    d AS (SELECT x.vec_id, w.label, sum(x.v * w.v) AS v FROM x JOIN w ON x.pos = w.pos GROUP BY x.vec_id, w.label)"""


def _factors(spark, sf_dir):
    """Vectors, centres and their product, which serves as incoming error."""
    a, b = matrices.to_long(_vectors(spark, sf_dir), "vec_id", "a"), _centres(spark, sf_dir)
    return a, b, matrices.product(a, b)


@catalog.add(f"""
    WITH {_SQL_CELLS}
    SELECT vec_id, pos, {sql_places("sum(d.v * w.v)")} AS v FROM d JOIN w ON d.label = w.label GROUP BY vec_id, pos
""")
def product_gradient_left(spark, sf_dir):
    _, b, delta = _factors(spark, sf_dir)
    cells = matrices.product_grad_left(delta, b)
    return cells.select(F.col("i").alias("vec_id"), F.col("j").cast("long").alias("pos"), places("v").alias("v"))


@catalog.add(f"""
    WITH {_SQL_CELLS}
    SELECT pos, label, {sql_places("sum(x.v * d.v)")} AS v FROM x JOIN d ON x.vec_id = d.vec_id GROUP BY pos, label
""")
def product_gradient_right(spark, sf_dir):
    a, _, delta = _factors(spark, sf_dir)
    cells = matrices.product_grad_right(a, delta)
    return cells.select(F.col("i").cast("long").alias("pos"), F.col("j").alias("label"), places("v").alias("v"))


@catalog.add(f"WITH {_SQL_CELLS} SELECT label, {sql_places('sum(v)')} AS v FROM d GROUP BY label")
def bias_gradient(spark, sf_dir):
    _, _, delta = _factors(spark, sf_dir)
    return matrices.bias_grad(delta).select(F.col("j").alias("label"), places("v").alias("v"))


@catalog.add(f"""
    SELECT vec_id, label, {sql_places("list_sum(a) / count(*) OVER (PARTITION BY label)", 9)} AS v FROM {_E}
""")
def mean_gradient(spark, sf_dir):
    """Error of every vector in the mean of its label, the incoming error being its own sum."""
    rows = _vectors(spark, sf_dir)
    sizes = rows.groupBy("label").agg(F.count("*").alias("n"))
    joined = rows.join(sizes, "label")
    return joined.select("vec_id", "label", places(matrices.mean_grad(V.total("a"), F.col("n")), 9).alias("v"))
