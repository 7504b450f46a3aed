from pyspark.sql import functions as F

from poilake.llm import linededup


def cut(spark, rows, **kw):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    return {r.doc_id: r for r in linededup.drop_boilerplate(docs, **kw).collect()}


def test_ratio_is_by_host(spark):
    rows = [(i, "a", f"Menu\nbody {i}\n") for i in range(6)] + [(10 + i, "b", "Menu\nx") for i in range(2)]
    rows += [(20 + i, "a", f"own {i}\nown {i}") for i in range(4)]
    got = cut(spark, rows, ratio=0.5, min_pages=2)
    assert got[0].text == "body 0\n" and (got[0].n_lines, got[0].n_dropped) == (3, 1)
    assert got[10].text == "" and got[20].text == "own 0\nown 0"
    assert cut(spark, rows, ratio=0.6, min_pages=2)[0].text == "Menu\nbody 0\n"  # exactly the ratio stays
    assert cut(spark, rows, ratio=0.5, min_pages=3)[10].text == "Menu\nx"


def test_copies_of_a_page_count_once(spark):
    rows = [(i, "a", "shared text\nof a copied page") for i in range(30)]
    rows += [(100 + i, "a", f"own {i}\nMenu\n") for i in range(6)] + [(200 + i, "a", f"line {i}") for i in range(40)]
    rows += [(300, "a", None), (301, "a", ""), (302, None, "Menu")]
    counted, once = (cut(spark, rows, ratio=0.1, once=o) for o in (False, True))
    assert counted[0].text == "" and counted[100].text == "own 0\nMenu\n"
    # 6 of 48 different pages: the copies neither hold boilerplate nor hide it.
    assert once[0].text == rows[0][2] and once[100].text == "own 0\n" and once[200].text == "line 0"
    assert once[300].text is None and once[301].text == "" and once[302].text == "Menu"
    assert cut(spark, rows, ratio=6 / 48, once=True)[100].n_dropped == 0


def test_rows_of_every_kind(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, "Menu"), (4, "a", " Menu "), (4, "a", " Menu "), (5, "a", "Menu\n\nMenu"), (6, "a", "z " * 100_000)]
    got = cut(spark, rows, ratio=0.2, min_pages=2)
    assert got[1].text is None and got[1].n_lines == 0
    assert got[2].text == "" and got[3].text == "Menu" and got[4].text == "" and got[5].text == ""
    assert len(got[6].text) == 200_000


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string").withColumns(
        {c: F.lit(1) for c in ("host", "keys", "lines", "n_lines", "salt", "row", "kept")}
    )
    out = linededup.drop_boilerplate(docs)
    assert out.collect() == [] and out.columns == ["doc_id", "source", "text", "host", "keys", "lines", "salt", "row", "kept", "n_lines", "n_dropped"]
