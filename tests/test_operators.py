import pytest
from frames import rows
from pyspark.sql import functions as F

from corpusml.functions.text import digest_bits
from corpusml.operators import groups, joins, matrices, ranking, sets
from corpusml.operators import rows as R


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.createDataFrame([(None, "l0"), (0, "l1"), (1, "l2"), (1, "l3"), (9, "l4")], "k int, a string")
    right = spark.createDataFrame([(None, "r0"), (0, "r1"), (1, "r2"), (7, "r3"), (7, "r4")], "j int, b string")
    return left, right


@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("left_outer", [False, True])
@pytest.mark.parametrize("right_outer", [False, True])
def test_joins_against_nested_loops(sides, left_outer, right_outer, null_safe):
    left, right = sides
    lrows, rrows = [tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()]

    def match(a, b):
        return a[0] == b[0] and (null_safe or a[0] is not None)

    wanted = [a + b for a in lrows for b in rrows if match(a, b)]
    if left_outer:
        wanted += [a + (None, None) for a in lrows if not any(match(a, b) for b in rrows)]
    if right_outer:
        wanted += [(None, None) + b for b in rrows if not any(match(a, b) for a in lrows)]
    got = joins.join(left, right, [(left.k, right.j)], left_outer, right_outer, null_safe)
    assert got.columns == ["k", "a", "j", "b"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_full_join_with_a_hot_key(spark):
    left = spark.range(300).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.createDataFrame([(0, "x"), (1, "y"), (-5, "z")], "j long, b string")
    got = joins.join(left, right, [(left.k, right.j)], left_outer=True, right_outer=True)
    assert got.count() == 301
    assert got.filter("b = 'x'").count() == 100
    assert got.filter("k is null").count() == 1


def test_join_all_is_a_full_product(spark):
    a = spark.createDataFrame([(1, "a1"), (1, "a2"), (2, "a3")], "k int, a string")
    b = spark.createDataFrame([(1, "b1"), (1, "b2")], "k int, b string")
    c = spark.createDataFrame([(1, "c1"), (3, "c2")], "k int, c string")
    assert joins.join_all([a, b, c], ["k"]).count() == 4


def test_common_word_join(spark):
    a = spark.createDataFrame([("lousy",), ("day",), ("sunny",)], "w string")
    b = spark.createDataFrame([("lousy",), ("lousy",), ("rain",)], "v string")
    assert rows(joins.join(a, b, [(a.w, b.v)])) == [("lousy", "lousy")] * 2


def test_augment_pairs_every_row_with_the_whole_side(spark):
    df = spark.range(3)
    side = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    got = R.augment(df, side, lambda s: R.as_map(s, "k", "v"))
    assert [r["side"] for r in got.collect()] == [{"a": 1, "b": 2}] * 3
    both = R.augment(df, [side, side], lambda s, t: R.as_map(s.unionByName(t).distinct(), "k", "v"))
    assert both.first()["side"] == {"a": 1, "b": 2}


def test_augment_checks_the_size_and_the_loader(spark):
    side = spark.range(5)
    with pytest.raises(ValueError):
        R.augment(spark.range(2), side, lambda s: s.agg(F.sum("id")), max_rows=4)
    with pytest.raises(Exception):
        R.augment(spark.range(2), side, lambda s: s).collect()


def test_a_map_of_a_large_view_is_an_error(spark):
    side = spark.range(10).withColumn("v", F.col("id"))
    assert len(R.as_map(side, "id", "v", 10).first()[0]) == 10
    with pytest.raises(Exception):
        R.as_map(side, "id", "v", 9).collect()


def test_only_row(spark):
    assert R.only_row(spark.range(1))["id"] == 0
    for n in (0, 2):
        with pytest.raises(ValueError):
            R.only_row(spark.range(n))


def test_filter_drops_null(spark):
    df = spark.createDataFrame([(1,), (None,), (0,)], "x int")
    assert rows(R.filter_rows(df, F.col("x") > 0)) == [(1,)]


def test_groups_with_null_zero_and_empty_keys(spark):
    df = spark.createDataFrame([(None, 1), (0, 2), (0, 3), (5, 4)], "k int, v int")
    assert rows(groups.count_groups(df, ["k"])) == [(None, 1), (0, 2), (5, 1)]
    assert rows(groups.sum_groups(df, ["k"], "v")) == [(None, 1), (0, 5), (5, 4)]
    lists = groups.group_rows(df, ["k"], F.col("v"))
    assert {r["k"]: r["items"] for r in lists.collect()} == {None: [1], 0: [2, 3], 5: [4]}
    texts = spark.createDataFrame([("", 1), ("a", 2)], "k string, v int")
    assert rows(groups.count_groups(texts, ["k"])) == [("", 1), ("a", 1)]


def test_a_hot_group_comes_whole_in_bounded_pieces(spark):
    # One key holds most rows, and one value most of that key.
    values = [("hot", i if i % 2 else -1) for i in range(1000)] + [("cold", 1), ("cold", 2)]
    df = spark.createDataFrame(values, "k string, v int")
    pieces = groups.group_rows(df, ["k"], F.col("v"), piece_rows=50).collect()
    hot = [r for r in pieces if r["k"] == "hot"]
    assert len(hot) > 5 and {r["pieces"] for r in hot} == {20}
    assert max(len(r["items"]) for r in hot) <= 250
    assert sorted(v for r in hot for v in r["items"]) == sorted(v for k, v in values if k == "hot")
    assert [r["items"] for r in pieces if r["k"] == "cold"] == [[1, 2]]


def test_fold_over_pieces(spark):
    values = [("hot", i) for i in range(500)] + [("cold", 7)]
    df = spark.createDataFrame(values, "k string, v long")

    def xor(a, b):
        return a.bitwiseXOR(b)

    got = groups.fold_groups(df, ["k"], F.col("v"), F.lit(0).cast("long"), xor, xor, piece_rows=7)
    wanted = 0
    for i in range(500):
        wanted ^= i
    assert rows(got) == [("cold", 7), ("hot", wanted)]


def test_concat_lists(spark):
    df = spark.createDataFrame([("d", [3, 1]), ("d", [2]), ("e", [])], "k string, xs array<int>")
    assert rows(groups.concat_lists(df, ["k"], "xs")) == [("d", 0, 1, [1, 2, 3]), ("e", 0, 1, [])]
    missing = spark.createDataFrame([("f", None), (None, []), ("g", [None])], "k string, xs array<int>")
    assert rows(groups.concat_lists(missing, ["k"], "xs")) == [(None, 0, 1, []), ("f", 0, 1, []), ("g", 0, 1, [None])]


def test_lookup_keeps_missing_values_of_the_side_table(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    side = spark.createDataFrame([(1, None), (3, 7)], "k int, v int")
    assert rows(joins.lookup(df, side, "k", "v", F.lit(-1))) == [(None, -1), (1, None), (2, -1)]


def test_roll_up_counters(spark):
    words = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", 4)], "label string, word string, n long")
    labels = spark.createDataFrame([("a", 3), ("b", 1)], "label string, n long")
    got = {tuple(r) for r in groups.roll_up_counters(words, labels).collect()}
    assert got == {
        ("a", "x", "label_word", 2), ("a", "y", "label_word", 1), ("b", "x", "label_word", 4),
        ("a", None, "label_words", 3), ("b", None, "label_words", 4),
        ("a", None, "label", 3), ("b", None, "label", 1), (None, None, "all", 4),
    }


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(2,), (1,)], "x int")
    assert rows(sets.union_distinct(a, b)) == [(None,), (1,), (2,)]
    assert rows(sets.distinct_rows(a)) == [(None,), (1,)]
    assert rows(sets.difference(b, a)) == [(2,)]


def test_top_k_breaks_ties_by_the_second_key(spark):
    df = spark.createDataFrame([("a", w, n) for w, n in [("z", 2), ("b", 2), ("c", 5), ("d", 1)]], "g string, w string, n int")
    top = ranking.top_k(df, "g", [F.desc("n"), F.asc("w")], 2)
    assert [(r["w"], r["rank"]) for r in top.orderBy("rank").collect()] == [("c", 1), ("b", 2)]


def test_hashed_rank_is_the_global_order(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("w"))
    got = ranking.hashed_rank(df, digest_bits(F.col("w")), F.col("w"), bits=5).select("w", "rank")
    ordered = df.select("w", digest_bits(F.col("w")).alias("d")).orderBy("d", "w").collect()
    assert {r["w"]: r["rank"] for r in got.collect()} == {r["w"]: i for i, r in enumerate(ordered)}


def test_shuffled_rank_is_a_permutation_per_epoch(spark):
    ids = spark.range(100).withColumnRenamed("id", "idx")
    first, second = ({r["idx"]: r["rank"] for r in ranking.shuffled_rank(ids, "idx", 1, e).collect()} for e in (0, 1))
    assert sorted(first.values()) == sorted(second.values()) == list(range(100))
    assert first != second
    again = ranking.shuffled_rank(ids.repartition(7), "idx", 1, 0).collect()
    assert {r["idx"]: r["rank"] for r in again} == first


def test_matrix_products_agree(spark):
    a = spark.createDataFrame([(0, [1.0, 2.0]), (1, [0.0, -1.0])], "i long, v array<double>")
    b = spark.createDataFrame([(0, 0, 3.0), (0, 1, 4.0), (1, 0, 5.0), (1, 1, 6.0)], "i int, j int, v double")
    long = {(r["i"], r["j"]): r["v"] for r in matrices.product(matrices.to_long(a, "i", "v"), b).collect()}
    assert long == {(0, 0): 13.0, (0, 1): 16.0, (1, 0): -5.0, (1, 1): -6.0}
    columns = spark.createDataFrame([(0, [3.0, 5.0]), (1, [4.0, 6.0])], "j int, column array<double>")
    small = matrices.times_small(a, "v", columns, "out")
    assert {r["i"]: r["out"] for r in small.collect()} == {0: [13.0, 16.0], 1: [-5.0, -6.0]}


def test_spread_uses_all_cores_on_small_inputs_only(spark):
    cores = spark.sparkContext.defaultParallelism
    assert R.spread(spark.range(100, numPartitions=1), "id").rdd.getNumPartitions() == cores
    many = spark.range(100, numPartitions=cores + 3)
    assert R.spread(many, "id") is many
