import pytest

from linkweave.functions import naming, text


def values(spark, expression, inputs):
    rows = [(i, value) for i, value in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i INT, c STRING").select("i", expression.alias("r"))
    return [row.r for row in sorted(df.collect(), key=lambda row: row.i)]


def test_block_key_edges(spark):
    inputs = [None, "null", " anna", "-x", "Élan", "ßen", "李", "123", "nullÉva", "Øre", "Æsir", "9-z"]
    expected = [None, None, " ", "-", "e", "s", None, None, "e", "o", "a", "-"]
    assert values(spark, text.block_key("c"), inputs) == expected


def test_block_key_of_other_scripts(spark):
    inputs = ["Жанна", "Щукин", "Эмма", "Юрий", "ёлка", "Ωμέγα", "Άννα", "שרה", "محمد", "ちえこ", "ガ", "김", "이", "우", "박", "꽃", "한", "漢", "1김"]
    expected = ["z", "s", "e", "y", "e", "o", "a", "s", "m", "t", "k", "k", "i", "u", "p", "k", "h", None, "k"]
    assert values(spark, text.block_key("c"), inputs) == expected


def test_ascii_name(spark):
    inputs = ["Straße", "Łódź", "Ñandú-Pérez", "Ærø", "Nguyễn", "anull b", None]
    expected = ["strasse", "lodz", "nandu-perez", "aero", "nguyen", "a b", None]
    assert values(spark, text.ascii_name("c"), inputs) == expected


def test_block_key_is_first_letter_of_ascii_name(spark):
    letters = [chr(c) for c in range(0x21, 0x250)]
    keys = values(spark, text.block_key("c"), letters)
    names = values(spark, text.ascii_name("c"), letters)
    assert keys == [name[:1] or None for name in names]


def test_prep_text_strips_as_python_does(spark):
    inputs = [" \t\n A b  　", "\x1cX\x1f", "Straße ", "", None, " y "]
    expected = [None if v is None else v.lower().strip() for v in inputs]
    assert values(spark, text.prep_text("c"), inputs) == expected


def test_full_name_skips_missing_parts(spark):
    df = spark.createDataFrame(
        [("a", None, "c"), (None, None, None), ("a", "b", "c")], "x STRING, y STRING, z STRING"
    )
    assert [r[0] for r in df.select(text.full_name("x", "y", "z")).collect()] == ["a c", "", "a b c"]


def test_composite_key_splits_at_last_underscore(spark):
    df = spark.createDataFrame([("a_b", 7), ("gpo", 12)], "t STRING, n BIGINT")
    keyed = df.withColumn("k", text.composite_key("t", "n"))
    rows = keyed.select("k", text.key_type("k"), text.key_id("k")).collect()
    assert [tuple(r) for r in rows] == [("a_b_7", "a_b", 7), ("gpo_12", "gpo", 12)]


def test_field_text_cuts_characters_not_bytes(spark):
    assert values(spark, text.field_text("c", 3), ["éèàü", None, "a"]) == ["éèà", None, "a"]


def test_canonical_json_ignores_key_order(spark):
    inputs = ['{"b": 1, "a": {"d": [1, 2], "c": "x"}}', '{"a":{"c":"x","d":[1,2]},"b":1}', "no json"]
    first, second, third = values(spark, text.canonical_json("c"), inputs)
    assert first == second and third is None


def test_range_text_has_colon_before_milliseconds(spark):
    row = spark.sql("SELECT timestamp '2021-02-03 04:05:06.789123' AS t").select(
        text.range_text("t").alias("r")
    )
    assert row.first().r == "2021-02-03 04:05:06:789"


@pytest.mark.parametrize(
    ("column", "title"),
    [
        ("full_name_src", "Source Full Name"),
        ("organization_name_tgt", "Target Organization Name"),
        ("fg_legacy_name_match_score", "Name Match Score"),
        ("fg_legacy_f_name_freq_src", "Source F Name Freq"),
        ("best_l_name_freq_src", "Source Best Last Name Freq"),
        ("ds_combined_score", "Ds Combined Score"),
    ],
)
def test_column_titles(column, title):
    assert naming.column_title(column) == title


def test_table_and_feature_names():
    assert naming.table_name("FgLegacy") == "fg_legacy"
    assert naming.features_by_group(["a.x", "b.y", "a.z"]) == {"a": ["x", "z"], "b": ["y"]}
    with pytest.raises(ValueError):
        naming.split_feature("plain")


def test_sentinels(spark):
    assert values(spark, text.drop_sentinel("c"), ["null", "nullable", None]) == [None, "nullable", None]
    assert values(spark, text.fill_sentinel("c"), [None, "x"]) == ["null", "x"]
