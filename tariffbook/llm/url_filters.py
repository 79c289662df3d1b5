"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a pattern over the *target* of a url, which is what follows the
first ``://`` with the host's A-Z in lower case. A literal token of a rule is a
run of letters and digits that any matching target must hold as a whole token.
The rule is filed under the one of its tokens that is rarest in the given urls.
The tokens of a url fetch the candidate rules, only those run their regular
expression, and the best fitting rule gives the verdict. All of it is native:
two scans of the url column, a join with the rules, one aggregate per target.

Pattern syntax: ``||`` at the start anchors to the begin of the host or of one
of its labels, ``|`` at either end to the target's begin or end, ``*`` stands
for anything, ``^`` for one separator or the end. The rest is literal.

Defined cases: a null url or one without ``://`` has an empty host, path and
target, and gets the default verdict unless a rule fits the empty target;
repeated rows are judged alike and all returned; an empty table gives an empty
result; a rule without any literal token is tried on every url. Other columns
of the input are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import literal_table
from tariffbook.operators.skew import lookup_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"


@dataclass(frozen=True)
class Rule:
    """``level``: a fitting rule of a higher level wins; within a level the longer name, then the later name."""

    name: str
    pattern: str
    action: str = "block"
    level: int = 0


def host_rule(host: str, path: str, action: str) -> Rule:
    """A rule for a host and its subdomains whose path starts with ``path``; outranks plain patterns."""
    if not path.startswith("/") or re.search(r"[?#]", path):
        raise ValueError(f"a rule's path starts with / and has no ? or #: {path!r}")
    return Rule(f"{host}{path}", f"||{host}{path}", action, 1)


POLICY = [
    host_rule("com", "/", "allow"),
    host_rule("example.com", "/en/", "block"),
    host_rule("www.example.com", "/en/", "allow"),
    host_rule("net", "/es/", "block"),
    host_rule("net", "/fr/", "block"),
]
PATTERNS = [
    Rule(p, p)
    for p in (
        "||spam-farm.", "||cheap-pills.", "||casino-win.", "||free-bets.", "||ads-track.", "||adult-x.",
        "/wp-login.", "/cgi-bin/", "||casino*/bonus^",
    )
]


def compiled(pattern: str) -> tuple[str, list[str]]:
    """The regular expression of a pattern, and the literal tokens that every match holds whole."""
    body, begin, end, left = pattern, "", "", False
    if body.startswith("||"):
        body, begin, left = body[2:], r"^(?:[^/?#]*\.)?", True
    elif body.startswith("|"):
        body, begin, left = body[1:], "^", True
    right = body.endswith("|")
    if right:
        body, end = body[:-1], "$"
    regex, tokens = [], []
    pieces = re.split(r"([*^])", body)
    for i, piece in enumerate(pieces):
        if piece in ("*", "^"):
            regex.append(".*" if piece == "*" else SEPARATOR)
            continue
        regex.append(re.escape(piece))
        bound_left = left if i == 0 else pieces[i - 1] == "^"
        bound_right = right if i == len(pieces) - 1 else pieces[i + 1] == "^"
        for m in re.finditer(r"[A-Za-z0-9]+", piece):
            if (m.start() > 0 or bound_left) and (m.end() < len(piece) or bound_right):
                tokens.append(m[0])
    return f"(?s){begin}{''.join(regex)}{end}", sorted(set(tokens))


def with_target(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``_host``, ``_path`` and ``_target`` to a table that has the column ``url``."""
    address = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(address, r"://([^/?#]*)", 1), UPPER, LOWER)
    return pages.select(
        "*",
        host.alias("_host"),
        F.regexp_extract(address, r"://[^/?#]*([^?#]*)", 1).alias("_path"),
        F.concat(host, F.regexp_extract(address, r"(?s)://[^/?#]*(.*)", 1)).alias("_target"),
    )


def _tokens(target: str = "_target"):
    return F.array_distinct(F.regexp_extract_all(F.col(target), F.lit(r"([A-Za-z0-9]+)"), F.lit(1)))


def rule_index(spark: SparkSession, targets: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules by their rarest literal token over all targets; token '' files the rules that have none.

    Only counts of the rules' own tokens reach the driver: as many rows as the rule list has tokens.
    """
    parts = {rule: compiled(rule.pattern) for rule in rules}
    wanted = sorted({token for _, tokens in parts.values() for token in tokens})
    counts = dict(
        targets.select(F.explode(_tokens()).alias("token"))
        .join(literal_table(spark, [("token", "string")], [(t,) for t in wanted]), "token")
        .groupBy("token")
        .count()
        .collect()
    )
    rows = [
        (min(tokens, key=lambda t: (counts.get(t, 0), t), default=""), rule.name, rule.action, rule.level, regex)
        for rule, (regex, tokens) in parts.items()
    ]
    schema = [("token", "string"), ("name", "string"), ("action", "string"), ("level", "int"), ("regex", "string")]
    return literal_table(spark, schema, rows)


def judge(pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, matched, level, verdict`` of every row; ``matched`` is the winning rule's name or null."""
    spark = pages.sparkSession
    rows = with_target(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("_url")), "_url")
    index = rule_index(spark, rows.select("_target"), rules)
    tokens = _tokens()
    if any(not compiled(rule.pattern)[1] for rule in rules):
        tokens = F.array_append(tokens, F.lit(""))
    best = (
        rows.select("_target", F.explode(tokens).alias("token"))
        .join(index, "token")
        .where(F.expr("_target RLIKE regex"))
        .groupBy("_target")
        .agg(F.max(F.struct("level", F.length("name").alias("n"), "name", "action")).alias("_best"))
    )
    return lookup_join(rows, best, "_target", "left").select(
        "page_id",
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_best.name").alias("matched"),
        F.col("_best.level").alias("level"),
        F.coalesce(F.col("_best.action"), F.lit("allow")).alias("verdict"),
    )


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the policy rules, and by the patterns where no policy rule fits."""
    judged = judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), POLICY + PATTERNS)
    policy = F.col("level") == 1
    return judged.select(
        "page_id", "host", "path", F.when(policy, F.col("matched")).alias("rule"), "verdict",
        F.when(~policy, F.col("matched")).alias("pattern"),
    )


OP1_SQL = r"""
WITH u AS (
    SELECT page_id, coalesce(url, '') AS url,
           translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
), t AS (
    SELECT *, host || CASE WHEN contains(url, '://')
                           THEN regexp_extract(url, '://[^/?#]*(.*)', 1, 's') ELSE '' END AS target
    FROM u
), r AS (
    SELECT *,
        CASE WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
             WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
             WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
             WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
             WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule,
        CASE WHEN regexp_matches(target, '^([^/?#]*\.)?casino.*/bonus([^A-Za-z0-9_.%-]|$)', 's') THEN '||casino*/bonus^'
             WHEN regexp_matches(target, '^([^/?#]*\.)?cheap-pills\.') THEN '||cheap-pills.'
             WHEN regexp_matches(target, '^([^/?#]*\.)?casino-win\.') THEN '||casino-win.'
             WHEN regexp_matches(target, '^([^/?#]*\.)?spam-farm\.') THEN '||spam-farm.'
             WHEN regexp_matches(target, '^([^/?#]*\.)?free-bets\.') THEN '||free-bets.'
             WHEN regexp_matches(target, '^([^/?#]*\.)?ads-track\.') THEN '||ads-track.'
             WHEN contains(target, '/wp-login.') THEN '/wp-login.'
             WHEN regexp_matches(target, '^([^/?#]*\.)?adult-x\.') THEN '||adult-x.'
             WHEN contains(target, '/cgi-bin/') THEN '/cgi-bin/' END AS hit
    FROM t
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN hit IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN hit END AS pattern
FROM r
"""
