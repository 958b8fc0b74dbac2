
from corpreg.functions import corporate_id, first_token, normalized_name


def _norm(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "raw string")
    return [r[0] for r in df.select(normalized_name("raw")).collect()]


def test_spellings_collapse_to_one_id(spark):
    # four spellings of one company give one id
    names = ["Finserve Inc.", "finserve llc", "FINSERVE international", "  Finserve,  "]
    df = spark.createDataFrame([(n,) for n in names], "raw_name string")
    ids = df.select(corporate_id("raw_name").alias("id")).distinct().collect()
    assert len(ids) == 1


def test_normalization_edges(spark):
    got = _norm(spark, ["Inc.", "X_co", "CO-OP Ltd", "Global Logistics_10", "Tab\tInc\t", "a  b Corp"])
    assert got == ["", "xco", "-op", "global logistics10", "tab\t\t", "a  b"]


def test_null_name_normalizes_to_null(spark):
    assert _norm(spark, [None]) == [None]


def test_id_is_md5_of_normalized_name(spark):
    df = spark.createDataFrame([("Acme Corp.",)], "n string")
    got = df.select(corporate_id("n")).first()[0]
    import hashlib

    assert got == hashlib.md5(b"acme").hexdigest()


def test_first_token(spark):
    df = spark.createDataFrame([("  Red Widget Inc",), ("",), ("   ",), (None,), ("solo",)], "n string")
    got = [r[0] for r in df.select(first_token("n")).collect()]
    assert got == ["red", "", "", None, "solo"]


def test_word_boundary_is_unicode_aware(spark):
    # "co" followed by a letter is not a separate word, so it stays
    assert _norm(spark, ["coé", "Co é", "Müller Co."]) == ["coé", "é", "müller"]
