"""Risk tag from a headline feed, without a Python UDF.

A company is flagged with the first headline (in feed order) that contains
the first whitespace token of the lower-cased company name and one of the
risk keywords; otherwise it gets ``None Identified``.

Plan:

* keyword filter on the feed once (it does not depend on the company); what
  passes is written once;
* distinct first tokens of the companies (one row per token, however many
  companies share it);
* containment ``contains(headline, token)`` is turned into an equi-join: a
  token meets the headlines on the one of its trigrams (the whole token, when
  that is shorter) that the fewest headlines have, so a frequent trigram is a
  key only for tokens that have no rarer one; the candidates are verified with
  ``contains``. The headlines' grams that some token has are written once;
* only the first match counts, so the feed is worked off in ranges of position,
  each ``RANGE_GROWTH`` times as long as all before it, and a token that has
  its headline takes no part in later ranges. A token that every headline
  contains meets the first range alone, however long the feed is;
  ``min(struct(position, headline))`` per token and range picks the headline;
* the per-token result is joined back to the companies on the token.

No side is broadcast by hand: the sizes that the adaptive planner measures
decide, and where both sides grow with the companies none is
(:func:`corpreg.session.shuffled`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpreg.functions.names import first_token
from corpreg.params import RISK_NONE, RISK_PREFIX, Params
from corpreg.session import materialize, shuffled

MAX_GRAM = 3
# headlines of the first range of positions, and how the ranges grow
FIRST_RANGE, RANGE_GROWTH = 1_000, 4


def risky_headlines(feed: DataFrame, params: Params = Params()) -> DataFrame:
    """Feed rows (position, headline, lower_headline) carrying a risk keyword."""
    low = F.lower("headline")
    has_kw = None
    for kw in params.risk_keywords:
        c = low.contains(kw)
        has_kw = c if has_kw is None else (has_kw | c)
    return feed.where(has_kw).select("position", "headline", low.alias("lower_headline"))


def _grams(text: Column, sizes) -> Column:
    """Distinct n-grams of a string for the given sizes, as an array. Each size
    puts the characters one place further on behind the grams of the size
    before, so the work grows with the length of the text."""
    chars = F.array_remove(F.split(text, ""), "")
    grams, arrays = chars, []
    for n in range(1, max(sizes) + 1):
        if n > 1:
            # the grams at the end have no character left and become null
            grams = F.zip_with(grams, F.slice(chars, n, F.size(chars)), lambda g, c: F.concat(g, c))
        if n in sizes:
            arrays.append(F.array_compact(grams))
    return F.array_distinct(F.concat(*arrays))


def headline_grams(headlines: DataFrame) -> DataFrame:
    """(position, gram): one row per distinct 1-, 2- or 3-gram of a headline."""
    return headlines.select("position", F.explode(_grams(F.col("lower_headline"), range(1, MAX_GRAM + 1))).alias("gram"))


def token_grams(tokens: DataFrame) -> DataFrame:
    """(token, n_grams, gram): the trigrams of each token, or a shorter token itself."""
    own = F.when(F.length("token") < MAX_GRAM, F.array("token")).otherwise(_grams(F.col("token"), [MAX_GRAM]))
    return tokens.select("token", F.size(own).alias("n_grams"), F.explode(own).alias("gram"))


def rarest_grams(tokens: DataFrame, grams: DataFrame) -> DataFrame:
    """(token, gram): of each token's grams the one in the fewest headlines;
    none for tokens with a gram that no headline has."""
    counts = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("headlines"))
    found = token_grams(tokens).join(shuffled(counts), "gram")
    rarest = found.groupBy("token", "n_grams").agg(
        F.count(F.lit(1)).alias("n_found"), F.min(F.struct("headlines", "gram")).alias("rarest")
    )
    return rarest.where("n_found = n_grams").select("token", F.col("rarest.gram").alias("gram"))


def position_bounds(hot: DataFrame, first: int = FIRST_RANGE) -> list:
    """Upper positions of all ranges but the last: about ``first`` headlines,
    then ``RANGE_GROWTH`` times as many up to each next one."""
    total, bounds, n = hot.count(), [], first
    while n < total:
        bounds.append(n / total)
        n *= RANGE_GROWTH
    if not bounds:
        return []
    found = hot.agg(F.percentile_approx("position", F.array(*map(F.lit, bounds)), F.lit(10_000)).alias("p")).first()["p"]
    return sorted(set(found))


def token_risk(
    tokens: DataFrame, feed: DataFrame, params: Params = Params(), first_range: int = FIRST_RANGE, joined: list | None = None
) -> DataFrame:
    """(token, adverse_media_news) for every token that hits a risky headline.

    ``tokens`` has one column ``token`` of distinct, non-empty tokens; positions
    are numbers. Headlines without a position are never the first. ``joined`` collects, by a
    count of its own, the (token, headline) candidates of every range.
    """
    tokens = materialize(tokens, "tokens")
    hot = materialize(risky_headlines(feed, params).where("position is not null").select("position", "headline"), "headlines")
    bounds = position_bounds(hot, first_range)
    number = sum((F.when(F.col("position") > b, 1).otherwise(0) for b in bounds), F.lit(0)).alias("range")
    wanted = token_grams(tokens).select("gram").distinct()
    grams = headline_grams(hot.select("position", F.lower("headline").alias("lower_headline")))
    grams = materialize(grams.join(wanted, "gram", "left_semi").select("gram", "position", number).repartition("range", "gram"), "grams", partition_by=["range"])
    left = rarest_grams(tokens, grams)
    answers = None
    for r in range(len(bounds) + 1):
        left = materialize(left, "tokens-left")
        if r and left.isEmpty():
            break
        inside = hot.where(F.col("position") > bounds[r - 1]) if r else hot
        inside = inside.where(F.col("position") <= bounds[r]) if r < len(bounds) else inside
        cand = left.join(grams.where(F.col("range") == r), "gram").select("token", "position")
        hits = cand.join(inside, "position").where(F.lower("headline").contains(F.col("token")))
        first = materialize(hits.groupBy("token").agg(F.min(F.struct("position", "headline")).alias("first")), "first-headlines")
        if joined is not None:
            joined.append(cand.count())
        answers = first if answers is None else answers.unionByName(first)
        left = left.join(shuffled(first), "token", "left_anti")
    return answers.select("token", F.concat(F.lit(RISK_PREFIX), F.col("first.headline")).alias("adverse_media_news"))


def risk_screen(
    companies: DataFrame, feed: DataFrame, params: Params = Params(), name_col: str = "corporate_name"
) -> DataFrame:
    """``companies`` plus ``adverse_media_news``."""
    with_tok = companies.withColumn("_token", first_token(name_col))
    tokens = with_tok.select(F.col("_token").alias("token")).where(F.col("token") != "").distinct()
    risk = token_risk(tokens, feed, params).withColumnRenamed("token", "_token")
    out = with_tok.join(risk, "_token", "left")
    return out.select(
        *companies.columns, F.coalesce("adverse_media_news", F.lit(RISK_NONE)).alias("adverse_media_news")
    )
