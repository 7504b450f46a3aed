import itertools
import random

from pyspark.sql import functions as F

from poilake.functions import text as T


def values(spark, column, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("t"))).collect()]


def test_clean_and_title_name(spark):
    names = ["  old  QUARTER ", "Miếu-quốc", "o'neil-bar 2nd", None]
    assert values(spark, T.clean_name, names) == ["Old  Quarter", "Miếu-quốc", "O'neil-bar 2nd", None]
    assert values(spark, T.title_name, names) == ["Old  Quarter", "Miếu-Quốc", "O'Neil-Bar 2Nd", None]


def test_safe_id(spark):
    assert values(spark, T.safe_id, ["My Place-One", None]) == ["my_place_one", None]


def test_token_sort_key_folds(spark):
    names = ["Văn Miếu, (Temple)!", "  ", None, "b_1 A"]
    # ă (U+0103) and ế (U+1EBF) lie above the deleted range, so both survive the default.
    assert values(spark, T.token_sort_key, names) == ["miếu temple văn", "", "", "a b_1"]
    assert values(spark, lambda c: T.token_sort_key(c, "unaccent"), ["Đền Quán Thánh"]) == ["den quan thanh"]
    assert values(spark, T.token_sort_key, ["Café Olé"]) == ["caf ol"]


def naive_lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_indel_ratio_equals_dynamic_programming():
    rng = random.Random(7)
    words = ["".join(rng.choices("abc đ", k=rng.randint(0, 12))) for _ in range(60)]
    for a, b in itertools.product(words, words):
        expected = 100 if a == b else 0 if not a or not b else round(200 * naive_lcs(a, b) / (len(a) + len(b)))
        assert T.indel_ratio(a, b) == expected


def test_token_sort_ratio(spark):
    pairs = [("Old Quarter", "quarter OLD"), ("abcd", "abce"), ("", ""), ("x", ""), (None, "x"), ("éé", "ôô")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = df.orderBy("i").select(T.token_sort_ratio(F.col("a"), F.col("b"))).collect()
    # The last two names are deleted altogether and so are equal.
    assert [r[0] for r in got] == [100, 75, 100, 0, None, 100]


def test_length_bound_never_hides_a_match(spark):
    rng = random.Random(3)
    words = ["".join(rng.choices("ab", k=rng.randint(1, 14))) for _ in range(80)]
    pairs = [(a, b) for a in words for b in words if T.indel_ratio(a, b) > 80]
    df = spark.createDataFrame(pairs, "a string, b string")
    assert df.where(~T.may_exceed(F.col("a"), F.col("b"), 80)).count() == 0


def test_ratios_of_long_names_and_many_pairs(spark):
    """More than 64 letters, letters outside the basic plane, nulls and repeated pairs in one batch."""
    rng = random.Random(8)
    texts = ["".join(rng.choices("abcđ漢𝄞 ", k=n)) for n in (1, 63, 64, 65, 127, 128, 129, 200) for _ in range(4)]
    pairs = [(a, b) for a in texts for b in texts]
    expected = [100 if a == b else round(200 * naive_lcs(a, b) / (len(a) + len(b))) for a, b in pairs]
    left, right = zip(*pairs)
    assert T.indel_ratios(list(left), list(right)).tolist() == expected
    rows = [*pairs[:40], *pairs[:3], (None, "a"), ("a", None)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(rows)], "i int, a string, b string").repartition(3)
    got = [r["s"] for r in df.select("i", T.key_similarity(F.col("a"), F.col("b")).alias("s")).orderBy("i").collect()]
    assert got == [*expected[:40], *expected[:3], None, None]
