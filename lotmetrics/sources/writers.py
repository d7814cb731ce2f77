"""Sinks: compact JSON lines and an RSS feed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compact_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One object a line, without null fields."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "true"}).alias("value")).write.mode(mode).text(path)


def escaped(c: Column) -> Column:
    """Text for XML."""
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def rss(items: DataFrame, title: str, link: str, most: int = 50) -> DataFrame:
    """One row, `value`: the feed of the `most` newest items (title, link, description, published)."""
    newest = items.orderBy(F.desc("published"), "link").limit(most)
    tags = [F.concat(F.lit(f"<{c}>"), escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit(f"</{c}>")) for c in ("title", "link", "description")]
    date = F.concat(F.lit("<pubDate>"), F.date_format("published", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit("</pubDate>"))
    rows = newest.select("published", "link", F.concat(F.lit("<item>"), *tags, date, F.lit("</item>")).alias("xml"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.unix_timestamp("published")).alias("at"), "link", "xml")))
    head = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>'), escaped(F.lit(title)), F.lit("</title><link>"), escaped(F.lit(link)), F.lit("</link>"))
    return rows.agg(F.concat(head, F.array_join(F.transform(ordered, lambda x: x["xml"]), ""), F.lit("</channel></rss>")).alias("value"))
