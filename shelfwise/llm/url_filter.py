"""URL filter lists: rules on a host, its subdomains and the start of a path.

A URL is expanded into expressions, a suffix of its host joined with a prefix of its path that
ends in a slash; no more of them than the deepest rule has labels and slashes. They meet the
rules on the first hex digits of their SHA-256, so the join moves eight characters for a rule, and
what meets is confirmed by the full digest, the host and the whole path.

Only the part of a URL that rules can tell apart is judged: the last labels of the host and the
first characters of the path. URLs are merged by it before anything is expanded or shuffled,
and the few verdicts are joined back, dealt over several rows each, so a host with a third of
all URLs is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import LOWER, UPPER, unused

ALLOW, BLOCK = "allow", "block"
# Hex digits of the digest by which expressions and rules are joined.
SHORT = 8
# Rows that each verdict is dealt over when it goes back to the URLs.
SPREAD = 16
# Types of the columns by which equal URLs ask for different ones of these rows.
_HASHED = {"string", "long", "integer", "double", "date", "timestamp", "timestamp_ntz", "binary", "boolean"}


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, with A-Z in lower case, and the path; both empty for a null or a text without ``://``.

    The host ends at the first slash, question mark or number sign after the first ``://``
    (user names and ports belong to it), the path at the first of the other two.
    """
    rest = F.when(F.instr(url, "://") > 0, F.call_function("substr", url, F.instr(url, "://") + 3))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "[.]"))


def _suffix(host: Column, labels: Column | int) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -(F.lit(labels) if isinstance(labels, int) else labels))


def _prefix(path: Column, slashes: Column) -> Column:
    """The path up to so many slashes, the last one included; none for no slash."""
    return F.when(slashes == 0, F.lit("")).otherwise(
        F.concat(F.call_function("substring_index", path, F.lit("/"), slashes), F.lit("/"))
    )


def _digest(host: Column, prefix: Column) -> Column:
    return F.sha2(F.encode(F.concat(host, F.lit(" "), prefix), "UTF-8"), 256)


def _rules(rules: DataFrame) -> DataFrame:
    """Rules under the digest of the host and of the path up to its last slash."""
    whole = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict")
    )
    digest = _digest(F.col("rule_host"), _prefix(F.col("rule_path"), _slashes(F.col("rule_path"))))
    return whole.withColumn("rule_digest", digest).withColumn("short", F.substring("rule_digest", 1, SHORT))


def _expressions(keys: DataFrame, labels: int, slashes: int) -> DataFrame:
    """Each key with all its host suffixes and path prefixes, at most ``labels * (slashes + 1)``."""
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.lit(labels), _labels(F.col("tail")))), lambda k: _suffix(F.col("tail"), k))
    prefixes = F.transform(F.sequence(F.lit(0), F.least(F.lit(slashes), _slashes(F.col("head")))), lambda k: _prefix(F.col("head"), k))
    expanded = keys.select("*", F.explode(suffixes).alias("suffix")).select("*", F.explode(prefixes).alias("prefix"))
    digest = _digest(F.col("suffix"), F.col("prefix"))
    return expanded.withColumn("digest", digest).withColumn("short", F.substring("digest", 1, SHORT))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = ALLOW) -> DataFrame:
    """The pages with ``host``, ``path``, ``rule`` and ``verdict`` added.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits a URL whose
    host is the rule's or one of its subdomains, and whose path starts with the rule's, which
    need not end in a slash. Of the rules that fit, the longest decides, counted in characters of
    host and path together; of equally long ones that with the longer host, then a block.
    Where none fits, ``rule`` is null and ``verdict`` is ``default``.

    A null URL, an empty one and one without ``://`` have an empty host and path, which only a rule
    of an empty host fits. Any length of URL is taken. Rules with a null are left out, and
    repeated ones count once. Repeated rows stay, and an empty table gives no row. The added
    names get underscores in front where a column has them.
    """
    listed = _rules(rules)
    # Three numbers come to the driver.
    labels, slashes, length = listed.agg(
        F.max(_labels(F.col("rule_host"))), F.max(_slashes(F.col("rule_path"))), F.max(F.length("rule_path"))
    ).first()
    host, path = (unused(pages, name) for name in ("host", "path"))
    rule, verdict = (unused(pages, name) for name in ("rule", "verdict"))
    own_host, own_path = host_and_path(F.col(url))
    split = pages.select("*", own_host.alias(host), own_path.alias(path))
    if labels is None:
        return split.select("*", F.lit(None).cast("string").alias(rule), F.lit(default).alias(verdict))

    tail, head, turn = (unused(split, name) for name in ("tail", "head", "turn"))
    keyed = split.withColumns({tail: _suffix(F.col(host), labels), head: F.substring(path, 1, length)})
    keys = keyed.select(F.col(tail).alias("tail"), F.col(head).alias("head")).distinct()
    fits = (
        (F.col("digest") == F.col("rule_digest"))
        & (F.col("suffix") == F.col("rule_host"))
        & F.startswith(F.col("head"), F.col("rule_path"))
    )
    order = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("all"),
        F.length("rule_host").alias("host"),
        (F.col("verdict") == BLOCK).alias("block"),
    )
    chosen = F.max_by(F.struct(F.concat("rule_host", "rule_path").alias("rule"), "verdict"), order)
    judged = _expressions(keys, labels, slashes).join(listed, "short").where(fits).groupBy("tail", "head").agg(chosen.alias("chosen"))

    # A verdict goes to its URLs in several rows, and each URL asks for one of them.
    dealt = judged.select("tail", "head", "chosen", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("turn"))
    own = {name: unused(keyed, f"judged_{name}") for name in ("tail", "head", "chosen", "turn")}
    dealt = dealt.withColumnsRenamed(own)
    told = [F.col(f.name) for f in pages.schema if f.dataType.typeName() in _HASHED]
    asked = keyed.withColumn(turn, F.pmod(F.xxhash64(*told), F.lit(SPREAD)).cast("int"))
    same = (
        (F.col(tail) == F.col(own["tail"])) & (F.col(head) == F.col(own["head"])) & (F.col(turn) == F.col(own["turn"]))
    )
    found = F.col(own["chosen"])
    return asked.join(dealt, same, "left").select(
        *pages.columns,
        host,
        path,
        found["rule"].alias(rule),
        F.coalesce(found["verdict"], F.lit(default)).alias(verdict),
    )
