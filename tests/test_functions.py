"""Column-expression helpers on hand-made values (the traps listed in the survey)."""

from pyspark.sql import functions as F

from bluelines.functions import codes, geometry, lists, rounding
from bluelines.operators import changes
from bluelines.operators.links import text_key


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_cut_label_widths(spark):
    s29, s30, s31 = "A" * 29, "B" * 30, "C" * 31
    got = one(spark, lists.cut_label(F.col("s")), "s string", [(s29,), (s30,), (s31,), (None,)])
    # shorter than 30 stays; 30 and more are cut to 28 + '..' (the code's rule, not the prose's)
    assert got == [s29, "B" * 28 + "..", "C" * 28 + "..", None]


def test_secondary_types_collapse_and_empty(spark):
    rows = [(["FR"],), (["FR", "OR", "OR", "PWS", "OR"],), (["FR", "FR", "FR"],), ([],)]
    got = one(spark, lists.secondary_types(F.col("t")), "t array<string>", rows)
    # a single type has no secondaries: NULL, not ''; the primary may equal the first secondary
    assert got == [None, "OR;PWS;OR", "FR", None]


def test_collapse_runs(spark):
    got = one(spark, lists.collapse_runs(F.col("t")), "t array<string>", [(["a", "a", "b", "a", "a"],), ([],)])
    assert got == [["a", "b", "a"], []]


def test_type_priority_unknown_is_null(spark):
    got = one(spark, lists.type_priority(F.col("t")), "t string", [("FR",), ("AR",), ("XX",), (None,)])
    assert got == [1, 5, None, None]


def test_two_rounding_rules(spark):
    rows = [(2.5,), (3.5,), (-2.5,), (1234.4999,)]
    even = one(spark, rounding.round_half_even_long(F.col("x")), "x double", rows)
    away = one(spark, rounding.round_half_away_int(F.col("x")), "x double", rows)
    assert even == [2, 4, -2, 1234]
    assert away == [3, 4, -3, 1234]


def test_piece_key_has_no_fraction(spark):
    got = one(spark, rounding.piece_key(F.col("b"), F.col("m")), "b bigint, m double", [(7, 12.5), (7, 0.0)])
    assert got == ["7.12500", "7.0"]


def test_codes(spark):
    rows = [("100.000300", "100"), ("100", "100"), ("1000", "100"), ("100.0003", "100.000300"), (None, "100")]
    within = one(spark, codes.is_within(F.col("a"), F.col("b")), "a string, b string", rows)
    strictly = one(spark, codes.is_strictly_within(F.col("a"), F.col("b")), "a string, b string", rows)
    assert within == [True, True, False, False, None]
    assert strictly == [True, False, False, False, None]
    pre = one(spark, codes.prefixes(F.col("a")), "a string", [("100.000300.0000000042",)])
    assert pre == [["100", "100.000300", "100.000300.0000000042"]]


def test_text_key(spark):
    rows = [("12 - PWS - 2011/09/29",), ("117 MILE CREEK - FR - 1986/06/23",), ("12 -X",), ("12 -FR",),
            (None,), ("x12 - A",)]
    got = one(spark, text_key(F.col("d")), "d string", rows)
    # '12 -X' and '12 -FR' pass the pattern but the part before ' - ' is no number: NULL, no error
    assert got == [12, None, None, None, None, None]


def test_object_path_and_cache_key(spark):
    rows = [("https://host.example.org/en/data/notes.gpkg.zip",), ("http://h/en/a/enx/b.txt?x=1#f",),
            ("https://h",), ("not a url",)]
    paths = one(spark, changes.object_path(F.col("u"), "en"), "u string", rows)
    assert paths == ["data/notes.gpkg.zip", "ax/b.txt", "", ""]  # every "/en" goes, as str.replace does
    keys = one(spark, changes.cache_key(F.col("p"), "prod"), "p string",
               [("data/notes.gpkg.zip",), ("a.b/c",), ("..x",), (".hidden",), ("dir/f.txt",)])
    assert keys == ["data/notes.gpkg.prod.filechange", "a.b/c.prod.filechange", "..x.prod.filechange",
                    ".hidden.prod.filechange", "dir/f.prod.filechange"]


def _line(spark):
    line = [{"x": 0.0, "y": 0.0, "m": 0.0}, {"x": 10.0, "y": 0.0, "m": 10.0}, {"x": 10.0, "y": 10.0, "m": 20.0}]
    return spark.createDataFrame([(line, 4.0, 3.0), (line, 12.0, 5.0), (line, -3.0, -4.0)],
                                 "g array<struct<x:double,y:double,m:double>>, px double, py double")


def test_closest_point(spark):
    df = _line(spark).select(geometry.closest_point(F.col("g"), F.col("px"), F.col("py")).alias("c"))
    got = [(round(r.c.dist, 9), round(r.c.along, 9), round(r.c.total, 9)) for r in df.collect()]
    assert got == [(3.0, 4.0, 20.0), (2.0, 15.0, 20.0), (5.0, 0.0, 20.0)]


def test_point_at_measure_and_between(spark):
    df = _line(spark).limit(1)
    p = df.select(geometry.point_at_measure(F.col("g"), F.lit(15.0)).alias("p")).first().p
    assert (p.x, p.y) == (10.0, 5.0)
    cut = df.select(geometry.between_measures(F.col("g"), F.lit(5.0), F.lit(15.0)).alias("c")).first().c
    assert [(v.x, v.y) for v in cut] == [(5.0, 0.0), (10.0, 0.0), (10.0, 5.0)]
    at_vertex = df.select(geometry.between_measures(F.col("g"), F.lit(10.0), F.lit(20.0)).alias("c")).first().c
    assert [(v.x, v.y) for v in at_vertex] == [(10.0, 0.0), (10.0, 10.0)]
    miss = df.select(geometry.between_measures(F.col("g"), F.lit(30.0), F.lit(40.0)).alias("c")).first().c
    assert miss == []


def test_prefixes_any_depth(spark):
    deep = ".".join(["100"] + [f"{i:06d}" for i in range(1, 25)])   # deeper than the format's 21 levels
    rows = [("100",), ("100.000300",), ("100.000300.0000000042",), (deep,)]
    got = one(spark, codes.prefixes(F.col("a")), "a string", rows)
    assert got[:3] == [["100"], ["100", "100.000300"], ["100", "100.000300", "100.000300.0000000042"]]
    assert len(got[3]) == 25 and got[3][-1] == deep
    assert one(spark, codes.level_range(F.lit(1), F.col("n")), "n int", [(0,), (2,)]) == [[], [1, 2]]


def test_canonical_row_form_tells_rows_apart(spark):
    """NULLs, separators inside texts, signs of zero, nested values: different rows, different hashes."""
    import datetime

    from bluelines.operators.changes import row_hash

    schema = "a string, b string, x double, f array<float>, d date, t timestamp, s struct<p:int,q:string>, m map<string,int>, v binary"
    base = ("x", None, 1.0, [1.0, None], datetime.date(2020, 1, 1), datetime.datetime(2020, 1, 1), (1, "z"), {"k": 1, "l": 2}, b"\x01")
    rows = [base, (None, "x", *base[2:]), ("x|", None, *base[2:]), ("", None, *base[2:]), (None, None, *base[2:]), ("x", "", *base[2:])]
    rows += [(*base[:2], x, *base[3:]) for x in (None, 0.0, -0.0, 1.0000000000000002, float("nan"), float("inf"), float("-inf"))]
    rows += [(*base[:3], f, *base[4:]) for f in (None, [], [None], [1.0], [None, 1.0], [1.0, None, None])]
    rows += [(*base[:4], datetime.date(2020, 1, 2), *base[5:]), (*base[:5], datetime.datetime(2020, 1, 1, 0, 0, 0, 1), *base[6:])]
    rows += [(*base[:6], s, *base[7:]) for s in (None, (None, "z"), (1, None), (None, None))]
    rows += [(*base[:7], m, *base[8:]) for m in (None, {}, {"k": 2, "l": 1})] + [(*base[:8], None), (*base[:8], b"")]
    df = spark.createDataFrame(rows, schema)
    hashes = [r.h for r in df.select(row_hash(df, df.columns).alias("h")).collect()]
    assert len(set(hashes)) == len(rows) and all(len(h) == 32 for h in hashes)
    turned = spark.createDataFrame([(*base[:7], {"l": 2, "k": 1}, base[8])], schema)
    assert turned.select(row_hash(turned, turned.columns).alias("h")).first().h == hashes[0]
