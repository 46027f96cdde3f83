"""URL verdicts: given rules first, then association rules mined with FP-growth; DataFrame operations only.

A given rule names a host (with its subdomains) and the beginning of a path. URLs that a rule fits are
labelled by it. From the labelled URLs FP-growth mines combinations of URL tokens that occur often enough
(support) and almost always under one verdict (confidence); a combination that a shorter one makes
superfluous goes. A URL that no rule fits is judged by the best mined rule whose tokens it all has. Rules
are found through an inverted index: each lies under its rarest token.

A URL has at most one token of each kind (`KINDS`), whatever its length, so the mined combinations of one
URL are bounded, and so is the driver's list of frequent tokens (kinds / support).
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airwave.session import stored

#: Host, path, verdict. A host stands for itself and its subdomains; the path is a prefix.
Rule = tuple[str, str, str]

ALLOW, BLOCK = "allow", "block"
#: Share of the labelled URLs that must hold a combination and its verdict.
SUPPORT = 0.005
#: Share of a combination's URLs that must have its verdict.
CONFIDENCE = 0.8
#: Tokens of a mined rule.
LONGEST = 3
#: Tokens of a URL, by kind, as expressions over scheme, host, path, query and fragment.
KINDS = {
    "scheme": "scheme",
    "tld": "coalesce(try_element_at(labels, -1), '')",
    "domain": "if(size(labels) > 1, array_join(slice(labels, -2, 2), '.'), '')",
    "host": "host",
    "sub": "if(size(labels) > 2, labels[0], '')",
    "first": "coalesce(get(segments, 0), '')",
    "second": "coalesce(get(segments, 1), '')",
    "ending": r"if(size(segments) > 0, regexp_extract(element_at(segments, -1), '[.]([A-Za-z0-9]+)$', 1), '')",
    "query": "regexp_replace(query, '=[^&]*', '')",
    "fragment": "if(fragment, 'yes', '')",
}


def url_parts(url: str = "url") -> dict[str, F.Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no `://`."""
    text = f"coalesce(cast({url} AS string), '')"
    rest = f"if(instr({text}, '://') > 0, substring({text}, instr({text}, '://') + 3), '')"
    lower = f"translate(regexp_extract({rest}, '^[^/?#]*', 0), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return {
        "host": F.expr(lower),
        "path": F.expr(f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"),
        "scheme": F.expr(f"if(instr({text}, '://') > 0, substring_index({text}, '://', 1), '')"),
        "query": F.expr(rf"regexp_extract({rest}, '^[^?#]*[?]([^#]*)', 1)"),
        "fragment": F.expr(f"instr({rest}, '#') > 0"),
    }


def given_rule(rules: list[Rule]) -> tuple[F.Column, F.Column]:
    """The longest rule that fits columns `host` and `path`, and its verdict; null where none does.

    Of equally long rules the one with the longer host counts. The list is part of the plan: it is meant
    for rules written by hand, not for a block list of millions.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[0])):
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits &= F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_tokens(urls: DataFrame) -> DataFrame:
    """Adds `tokens`, distinct texts `kind=value`, to rows with the columns of `url_parts`."""
    values = ", ".join(f"struct('{kind}=' AS kind, {text} AS value)" for kind, text in KINDS.items())
    cut = urls.select(
        "*",
        F.expr("filter(split(host, '[.]'), x -> x <> '')").alias("labels"),
        F.expr("filter(split(path, '/'), x -> x <> '')").alias("segments"),
    )
    tokens = f"transform(filter(array({values}), x -> x.value <> ''), x -> x.kind || x.value)"
    return cut.withColumn("tokens", F.expr(tokens)).drop("labels", "segments")


def mine_rules(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    longest: int = LONGEST,
) -> DataFrame:
    """Rules (tokens, verdict, hits, confidence, rarest) from rows (tokens, verdict), stored.

    `hits` counts the labelled URLs with all tokens and the verdict; `rarest` is the token to look a rule up by.
    A rule stays only where its confidence is above that of every rule of fewer of its tokens with the same
    verdict. Without labelled rows there are no rules.
    """
    spark = labelled.sparkSession
    schema = "tokens array<string>, verdict string, hits long, confidence double, rarest string"
    items = labelled.select(
        F.concat("tokens", F.array(F.concat(F.lit("verdict="), F.col("verdict")))).alias("items")
    )
    if items.isEmpty():
        return spark.createDataFrame([], schema)
    grown = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(items)
    said = "substring(get(filter(items, x -> x LIKE 'verdict=%'), 0), 9)"
    sets = stored(
        grown.freqItemsets.where(f"size(items) <= {longest + 1}").select(
            F.expr("array_sort(filter(items, x -> x NOT LIKE 'verdict=%'))").alias("tokens"),
            F.expr(said).alias("verdict"),
            F.col("freq").alias("hits"),
        )
    )
    found = sets.where(f"verdict IS NOT NULL AND size(tokens) BETWEEN 1 AND {longest}")
    all_of = sets.where("verdict IS NULL").select("tokens", F.col("hits").alias("all_hits"))
    sure = (
        found.join(all_of, "tokens")
        .withColumn("confidence", F.col("hits") / F.col("all_hits"))
        .where(F.col("confidence") >= confidence)
        .drop("all_hits")
    )
    # Every proper, non-empty part of a rule's tokens: at most 2^longest - 2 rows a rule.
    part = "filter(tokens, (x, i) -> (mask & shiftleft(1, i)) > 0)"
    parts = sure.withColumn(
        "mask", F.explode(F.expr("sequence(1, greatest(shiftleft(1, size(tokens)) - 2, 1))"))
    ).select("tokens", "verdict", F.expr(part).alias("part"))
    shorter = sure.select(
        F.col("tokens").alias("part"), "verdict", F.col("confidence").alias("shorter")
    )
    above = (
        parts.where("size(part) < size(tokens)")
        .join(shorter, ["part", "verdict"])
        .groupBy("tokens", "verdict")
        .agg(F.max("shorter").alias("shorter"))
    )
    kept = sure.join(above, ["tokens", "verdict"], "left").where(
        "shorter IS NULL OR confidence > shorter"
    )
    single = all_of.where("size(tokens) = 1").select(
        F.col("tokens")[0].alias("token"), F.col("all_hits")
    )
    rarest = (
        kept.select("tokens", F.explode("tokens").alias("token"))
        .join(single, "token")
        .groupBy("tokens")
        .agg(F.min_by("token", F.struct("all_hits", "token")).alias("rarest"))
    )
    return stored(
        kept.join(rarest, "tokens").select("tokens", "verdict", "hits", "confidence", "rarest")
    )


def best_rules(token_sets: DataFrame, mined: DataFrame) -> DataFrame:
    """(tokens, mined, mined_verdict) for the token sets that have all tokens of some mined rule.

    The highest confidence counts, then the most hits, then the fewest tokens, then their text and verdict.
    """
    rules = mined.select(
        F.col("rarest").alias("token"),
        F.col("tokens").alias("wanted"),
        F.struct("confidence", "hits", (-F.size("tokens")).alias("shortness")).alias("merit"),
        F.array_join("tokens", "&").alias("mined"),
        F.col("verdict").alias("mined_verdict"),
    )
    looked_up = token_sets.withColumn("token", F.explode("tokens")).join(rules, "token")
    fits = looked_up.where(F.size(F.array_except("wanted", "tokens")) == 0)
    best = Window.partitionBy("tokens").orderBy(F.col("merit").desc(), "mined", "mined_verdict")
    return (
        fits.withColumn("place", F.row_number().over(best))
        .where("place = 1")
        .select("tokens", "mined", "mined_verdict")
    )


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    otherwise: str = ALLOW,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined), one row per row of `pages`.

    `rule` is the given rule that fits (null if none), `mined` the mined rule that decided instead (null if
    none; then `otherwise` is the verdict). A null URL and one without `://` have an empty host and path and
    no tokens. Repeated rows and repeated page_ids are judged alike and all stay; each counts as a label.
    Only page_id and url are read. An empty table gives no rows.
    """
    parts = url_parts()
    plain = pages.select("page_id", *(column.alias(name) for name, column in parts.items()))
    rule, verdict = given_rule(rules)
    judged = with_tokens(plain).select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("given"), "tokens"
    )
    labelled = judged.where("rule IS NOT NULL").select("tokens", F.col("given").alias("verdict"))
    mined = mine_rules(labelled, support, confidence)
    # Each distinct token set is looked up once, however many pages share it.
    open_sets = judged.where("rule IS NULL").select("tokens").distinct()
    best = best_rules(open_sets, mined)
    unruled = F.col("rule").isNull()
    return judged.join(best, "tokens", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(unruled, F.coalesce("mined_verdict", F.lit(otherwise)))
        .otherwise(F.col("given"))
        .alias("verdict"),
        F.when(unruled, F.col("mined")).alias("mined"),
    )


def _rules_sql(rules: list[Rule], column: str) -> str:
    cases = " ".join(
        f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"
        f" THEN '{host + path if column == 'rule' else says}'"
        for host, path, says in sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r[0]))
    )
    return f"CASE {cases} ELSE NULL END"


def judge_sql(rules: list[Rule]) -> str:
    """The same rows in DuckDB's SQL, the rules mined by counting all sets of up to three tokens."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return rf"""
WITH rests AS (
    SELECT row_number() OVER () AS row, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN url[:strpos(url, '://') - 1] ELSE '' END AS scheme,
        CASE WHEN strpos(url, '://') > 0 THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT row, page_id, scheme,
        translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{lower}') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_replace(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '=[^&]*', '', 'g') AS query,
        contains(rest, '#') AS fragment
    FROM rests
), cut AS (
    SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
        list_filter(string_split(path, '/'), lambda x: x <> '') AS segments
    FROM parts
), judged AS (
    SELECT row, page_id, host, path, {_rules_sql(rules, "rule")} AS rule,
        {_rules_sql(rules, "verdict")} AS given,
        list_transform(list_filter([
            ['scheme=', scheme], ['tld=', coalesce(labels[-1], '')],
            ['domain=', CASE WHEN len(labels) > 1 THEN labels[-2] || '.' || labels[-1] ELSE '' END],
            ['host=', host], ['sub=', CASE WHEN len(labels) > 2 THEN labels[1] ELSE '' END],
            ['first=', coalesce(segments[1], '')], ['second=', coalesce(segments[2], '')],
            ['ending=', coalesce(regexp_extract(segments[-1], '[.]([A-Za-z0-9]+)$', 1), '')],
            ['query=', query], ['fragment=', CASE WHEN fragment THEN 'yes' ELSE '' END]
        ], lambda x: x[2] <> ''), lambda x: x[1] || x[2]) AS tokens
    FROM cut
), labelled AS (
    SELECT row, given, unnest(tokens) AS t FROM judged WHERE rule IS NOT NULL
), least AS (
    SELECT ceil({SUPPORT}::DOUBLE * count(*)) AS least FROM judged WHERE rule IS NOT NULL
), sets AS (
    SELECT given, [t] AS s FROM labelled
    UNION ALL
    SELECT a.given, [a.t, b.t] FROM labelled a JOIN labelled b ON a.row = b.row AND a.t < b.t
    UNION ALL
    SELECT a.given, [a.t, b.t, c.t] FROM labelled a
    JOIN labelled b ON a.row = b.row AND a.t < b.t JOIN labelled c ON a.row = c.row AND b.t < c.t
), sure AS (
    SELECT s, given, hits, hits::DOUBLE / all_hits AS confidence
    FROM (SELECT s, given, count(*) AS hits FROM sets GROUP BY s, given)
    JOIN (SELECT s, count(*) AS all_hits FROM sets GROUP BY s) USING (s), least
    WHERE hits >= least AND hits::DOUBLE / all_hits >= {CONFIDENCE}
), mined AS (
    SELECT * FROM sure r WHERE NOT EXISTS (
        SELECT 1 FROM sure o WHERE o.given = r.given AND len(o.s) < len(r.s)
            AND list_has_all(r.s, o.s) AND o.confidence >= r.confidence)
), best AS (
    SELECT j.row, array_to_string(m.s, '&') AS mined, m.given AS says
    FROM judged j JOIN mined m ON list_has_all(j.tokens, m.s)
    WHERE j.rule IS NULL
    QUALIFY row_number() OVER (PARTITION BY j.row ORDER BY m.confidence DESC, m.hits DESC,
        len(m.s), array_to_string(m.s, '&'), m.given) = 1
)
SELECT page_id, host, path, rule, coalesce(given, says, 'allow') AS verdict, mined
FROM judged LEFT JOIN best USING (row)
"""
