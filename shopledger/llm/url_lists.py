"""URL filters that change over time: an as-of join with dated list entries.

An entry says that a pattern was added to or removed from a list at some time. The
entries become validity intervals, and each capture is judged by those that held at
its fetch time. A pattern is a host with at least two labels, which covers its
subdomains, or a host and a path, which covers what lies below. Built-in functions
only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, valid_from, valid_to): when each pattern was on its list, from
    inclusive, to exclusive, null while it still is. ``entries`` has list, pattern,
    action ('add' or 'remove') and dated. Of entries at one time the removals count
    first. Repeated additions or removals change nothing; entries with a null count
    as absent."""
    order = Window.partitionBy("list", "pattern").orderBy("dated", F.desc("action"))
    changes = (
        entries.select("list", F.lower("pattern").alias("pattern"), "action", "dated")
        .where("action in ('add', 'remove')")
        .dropna()
        .withColumn("before", F.lag("action", 1, "remove").over(order))
        .where("action <> before")
        .withColumn("valid_to", F.lead("dated").over(order))
    )
    return changes.where("action = 'add'").select("list", "pattern", F.col("dated").alias("valid_from"), "valid_to").where(
        "valid_to is null or valid_to > valid_from"
    )


def with_patterns(captures: DataFrame) -> DataFrame:
    """Adds ``host`` and ``patterns``, all patterns that would cover the url: the host,
    its parents of two labels or more, and the host with each leading part of the
    path. Scheme, user, port, query and fragment do not count, nor does case."""
    parts = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)(?::[0-9]*)?(/[^?#]*)?"
    rows = captures.withColumn("host", F.nullif(F.lower(F.regexp_extract("url", parts, 1)), F.lit(""))).withColumn(
        "_path", F.filter(F.split(F.lower(F.regexp_extract("url", parts, 2)), "/"), lambda s: s != "")
    )
    labels = F.split("host", r"\.")
    count = F.size(labels)
    parents = F.when(
        count >= 2, F.transform(F.sequence(F.lit(2), count), lambda n: F.array_join(F.slice(labels, count - n + 1, n), "."))
    ).otherwise(F.array("host"))
    paths = F.when(
        F.size("_path") > 0,
        F.transform(
            F.sequence(F.lit(1), F.size("_path")),
            lambda n: F.concat("host", F.lit("/"), F.array_join(F.slice("_path", 1, n), "/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    return rows.withColumn("patterns", F.when(F.col("host").isNotNull(), F.concat(parents, paths))).drop("_path")


def judged(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """Every row of ``captures`` (url, fetched_at and others) with host, n_active (entries
    that cover the url and held at fetch time), verdict and pattern.

    The longest active pattern decides, and of equals an entry of the list 'allow'
    before others: verdict 'allow' or 'block'. No active entry: 'pass'. A url
    without host or a null fetch time: 'unknown', with no active entries. Repeated
    captures are judged alike. A column of ``captures`` named like one of the four new
    ones gives way to it; any other stays, whatever its name."""
    carried = {c: f"input_{i}" for i, c in enumerate(captures.columns) if c.lower() not in ("url", "fetched_at")}
    rows = with_patterns(captures.select("url", "fetched_at", *(F.col(f"`{c}`").alias(n) for c, n in carried.items())))
    asked = rows.where("patterns is not null and fetched_at is not null")
    # Captures of one url at one time are asked once.
    asked = asked.select("url", "fetched_at", "patterns").dropDuplicates(["url", "fetched_at"])
    held = asked.select("url", "fetched_at", F.explode("patterns").alias("pattern")).join(intervals(entries), "pattern").where(
        "fetched_at >= valid_from and (valid_to is null or fetched_at < valid_to)"
    )
    strength = F.struct(F.length("pattern").alias("long"), (F.col("list") == "allow").alias("allow"), "pattern")
    found = held.groupBy("url", "fetched_at").agg(F.count("*").alias("active"), F.max(strength).alias("best"))
    known = F.col("host").isNotNull() & F.col("fetched_at").isNotNull()
    return rows.join(found, ["url", "fetched_at"], "left").select(
        *(
            F.col(carried.get(c, c)).alias(c)
            for c in captures.columns
            if c.lower() not in ("host", "n_active", "verdict", "pattern")
        ),
        "host",
        F.coalesce("active", F.lit(0)).alias("n_active"),
        F.when(~known, "unknown")
        .when(F.col("best").isNull(), "pass")
        .when(F.col("best.allow"), "allow")
        .otherwise("block")
        .alias("verdict"),
        F.col("best.pattern").alias("pattern"),
    )


def dated_lists(pages: DataFrame) -> DataFrame:
    """List entries for the captures of a crawl table, made from the hosts it names:
    which hosts and paths are listed, and when, follows from a digest of the name."""
    hosts = with_patterns(pages.select("url")).where("host is not null")
    names = hosts.select(F.explode("patterns").alias("pattern")).distinct()
    digest = F.conv(F.substring(F.md5("pattern"), 1, 7), 16, 10).cast("long")
    names = names.withColumn("d", digest)
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    day = F.col("d") % 20
    moves = F.filter(
        F.array(
            *(
                F.struct(
                    F.lit(kind).alias("list"),
                    F.lit(action).alias("action"),
                    (start + F.make_interval(days=(day + after).cast("int"))).alias("dated"),
                    (F.col("d") % every == rest).alias("there"),
                )
                for kind, action, after, every, rest in LIST_MOVES
            )
        ),
        lambda m: m["there"],
    )
    return names.select("pattern", F.explode(moves).alias("m")).select("m.list", "pattern", "m.action", "m.dated")


# (list, action, days after the first, of every so many digests, those with this rest)
LIST_MOVES = (
    ("block", "add", 0, 3, 0),
    ("block", "remove", 6, 6, 0),
    ("block", "add", 9, 12, 0),
    ("allow", "add", 2, 7, 1),
    ("allow", "remove", 8, 14, 1),
)


def captures_of(pages: DataFrame) -> DataFrame:
    """page_id, url and the fetch time that the page number stands for."""
    hours = (F.col("page_id") * 37 % 720).cast("int")
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    return pages.select("page_id", "url", (start + F.make_interval(hours=hours)).alias("fetched_at"))
