import pytest

from featurekit.operators import DropColumns, KeepColumns, OneHot, ValueMapper, mapping_coverage
from featurekit.operators import mapping as mp


def test_mapping_golden(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",), ("A",)], "c string")
    out = ValueMapper("c", {"A": 1, "B": 2, "C": 3}).transform(df)
    assert [r[0] for r in out.collect()] == [1, 2, 3, 1]


def test_mapping_swap_is_simultaneous(spark):
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    out = ValueMapper("c", {"a": "b", "b": "a"}).transform(df)
    assert [r[0] for r in out.collect()] == ["b", "a", "z"]


def test_mapping_null_key_and_unmapped_modes(spark):
    df = spark.createDataFrame([("a",), (None,), ("zz",)], "c string")
    assert [r[0] for r in ValueMapper("c", {"a": 1, None: 7}).transform(df).collect()] == [1, 7, None]
    assert [r[0] for r in ValueMapper("c", {"a": 1}, unmapped="null").transform(df).collect()] == [1, None, None]
    with pytest.raises(Exception):
        ValueMapper("c", {"a": 1}, unmapped="error").transform(df).collect()


def test_mapping_large_dicts_use_map_and_join(spark, monkeypatch):
    df = spark.range(200).selectExpr("cast(id as string) as c", "cast(id as string) as k")
    mapping = {str(i): i * 2 for i in range(150)}
    expected = {str(i): (i * 2 if i < 150 else i) for i in range(200)}
    got = {r.k: r.c for r in ValueMapper("c", mapping).transform(df).collect()}
    assert got == expected
    monkeypatch.setattr(mp, "MAP_MAX_KEYS", 10)
    got = {r.k: r.c for r in ValueMapper("c", mapping).transform(df).collect()}
    assert got == expected


def test_mapping_checks(spark):
    with pytest.raises(TypeError):
        ValueMapper("c", [("a", 1)])
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(ValueError):
        ValueMapper("x", {"a": 1}).transform(df)


def test_coverage(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    rows = {(r.value, r.side) for r in mapping_coverage(df, "c", {"a": 1, "q": 2}).collect()}
    assert rows == {("q", "key_not_in_data"), ("b", "value_without_key"), (None, "value_without_key")}


def test_onehot_golden(spark):
    df = spark.createDataFrame([("red",), ("blue",), ("green",), ("red",)], "color string")
    out = OneHot("color").transform(df)
    assert out.columns == ["color_blue", "color_green", "color_red"]
    assert [tuple(r) for r in out.collect()] == [(0, 0, 1), (1, 0, 0), (0, 1, 0), (0, 0, 1)]


def test_onehot_missing_and_order(spark):
    df = spark.createDataFrame([(1, "b", 9), (2, None, 9), (3, "a", 9), (4, "b", 9)], "k int, c string, z int")
    out = OneHot("c").transform(df)
    assert out.columns == ["k", "z", "c_a", "c_b"]
    assert [tuple(r) for r in out.collect()][1] == (2, 9, 0, 0)


def test_onehot_fitted_on_new_data_and_guard(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    model = OneHot("c").fit(train)
    out = model.transform(spark.createDataFrame([("b",), ("zz",)], "c string"))
    assert out.columns == ["c_a", "c_b"] and [tuple(r) for r in out.collect()] == [(0, 1), (0, 0)]
    with pytest.raises(ValueError):
        OneHot("c", max_categories=1).fit(train)


def test_dotted_names_resolve(spark):
    df = spark.createDataFrame([(1.0,), (2.0,)], "c double")
    out = OneHot("c").transform(df)
    assert out.columns == ["c_1.0", "c_2.0"]
    assert DropColumns(["c_1.0"]).transform(out).columns == ["c_2.0"]


def test_drop_keep(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, B int, C int")
    assert DropColumns(["B", "nope"]).transform(df).columns == ["A", "C"]
    assert KeepColumns(["C", "A"]).transform(df).columns == ["C", "A"]
    with pytest.raises(ValueError):
        KeepColumns(["A", "nope"]).transform(df)
