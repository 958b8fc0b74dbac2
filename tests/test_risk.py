import random

from pyspark.sql import functions as F

from corpreg.operators.risk import headline_grams, rarest_grams, risk_screen, token_risk
from corpreg.params import RISK_NONE, RISK_PREFIX, Params
from corpreg.plans.catalog import QUERIES


def risk_tag_python(name: str | None, headlines, keywords=("fine", "breach", "fraud")) -> str:
    """Plain-Python statement of the rule."""
    if name is None or not name.split():
        return RISK_NONE
    target = name.lower().split()[0]
    for h in headlines:
        low = h.lower()
        if target in low and any(k in low for k in keywords):
            return RISK_PREFIX + h
    return RISK_NONE


def _feed(spark, headlines):
    return spark.createDataFrame([(i + 1, h) for i, h in enumerate(headlines)], "position int, headline string")


def _check(spark, names, headlines, params=Params()):
    comp = spark.createDataFrame([(str(i), n) for i, n in enumerate(names)], "corporate_id string, corporate_name string")
    got = {r["corporate_id"]: r["adverse_media_news"] for r in risk_screen(comp, _feed(spark, headlines), params).collect()}
    want = {str(i): risk_tag_python(n, headlines) for i, n in enumerate(names)}
    assert got == want


def test_examples(spark):
    heads = ["Regulator suspects fines for Norwind", "Harbor Lines LLC grows fast", "Fraud inquiry at Quillbank Inc.", "Norwind breach"]
    _check(spark, ["Norwind Inc.", "Quillbank LLC", "Harbor Lines LLC", "Nobody", "   ", ""], heads)


def test_random_equivalence_with_python_rule(spark):
    rng = random.Random(3)
    words = ["red", "re", "r", "old", "cold", "fine", "bolt", "x", "ab", "breach"]
    names = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(200)]
    heads = [" ".join(rng.choice(words + ["fraud", "news"]) for _ in range(rng.randint(1, 6))) for _ in range(40)]
    _check(spark, names, heads)


def test_token_meets_headlines_on_its_rarest_trigram(spark):
    """A trigram that every headline has is no key for a token with a rarer one."""
    feed = _feed(spark, [f"the{i % 10}th fine {i}" for i in range(300)] + ["theorem fine"])
    grams = headline_grams(feed.select("position", F.lower("headline").alias("lower_headline")))
    tokens = spark.createDataFrame([("theorem",), ("the",), ("thesis",), ("fi",)], "token string")
    got = {r["token"]: r["gram"] for r in rarest_grams(tokens, grams).collect()}
    assert set(got) == {"theorem", "the", "fi"} and got["the"] == "the" and got["fi"] == "fi"
    assert grams.where(grams.gram == got["theorem"]).count() == 1


def test_fixture_tag_counts(spark):
    df = QUERIES["risk_screen"](spark, "/root/testdata/sf0.01")
    counts = {r[0]: r[1] for r in df.groupBy("adverse_media_news").count().collect()}
    assert counts == {
        "None Identified": 2527,
        "Flagged Local Risk Scan: Data breach at cold store": 38,
        "Flagged Local Risk Scan: Red tape fines suspected": 35,
        "Flagged Local Risk Scan: Old mill fraud inquiry opened": 30,
    }


def test_unusual_whitespace_matches_python_split(spark):
    names = ["\x1cred\x1dwidget", " old mill", "\tcold\x1fstore", "　blue chip"]
    _check(spark, names, ["Red tape fines", "Old mill fraud", "Data breach at cold store", "Blue fraud"])


def test_ranges_of_position_equal_one_range(spark):
    """First headlines found range by range, with ties and gaps in the positions."""
    rng = random.Random(12)
    words = ["red", "re", "cold", "bolt", "xylem", "ab", "zinc", "quay"]
    heads = [(rng.randint(1, 900) * 3, " ".join(rng.choice(words[: rng.randint(1, 8)]) for _ in range(5)) + " fine") for _ in range(700)] + [(None, "never fine")]
    feed = spark.createDataFrame(heads, "position int, headline string")
    tokens = spark.createDataFrame([(w,) for w in [*words, "never", "none", "o", "d", "lt"]], "token string")
    got = {r["token"]: r["adverse_media_news"] for r in token_risk(tokens, feed, first_range=20).collect()}
    want = {}
    for (token,) in tokens.collect():
        hits = [h for h in heads if h[0] is not None and token in h[1].lower()]
        if hits:
            want[token] = RISK_PREFIX + min(hits)[1]
    assert got == want
    assert got == {r["token"]: r["adverse_media_news"] for r in token_risk(tokens, feed).collect()}
    assert token_risk(tokens, feed.where("false")).collect() == [] == token_risk(tokens.where("false"), feed).collect()


def test_answered_tokens_leave_the_feed(spark):
    """Every headline contains the tokens: the joined rows stay with the first range, whatever the feed's length."""
    tokens = spark.createDataFrame([("the",), ("fine",), ("th",)], "token string")
    for n in (800, 3200):
        feed = spark.range(1, n + 1).select(F.col("id").alias("position"), F.concat(F.lit("the fine "), "id").alias("headline"))
        joined = []
        assert token_risk(tokens, feed, first_range=50, joined=joined).count() == 3
        assert len(joined) == 1 and sum(joined) <= 3 * 60
    # one token only the last headline has: the others are gone by then
    late = feed.unionByName(spark.createDataFrame([(10_000, "zebra fine")], feed.schema))
    joined = []
    got = token_risk(tokens.unionByName(spark.createDataFrame([("zebra",)], "token string")), late, first_range=50, joined=joined).collect()
    assert len(got) == 4 and len(joined) > 2 and sum(joined) <= 3 * 60 + 1
