"""Text expressions, all inside the JVM except the decoding of HTML entities."""

from __future__ import annotations

import html
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats and patterns whose results other systems compare.
TRUNCATION_MARK = "\n[content truncated at {cap} bytes of {size}]"
REDACTED = "[redacted]"
SECRET_PATTERNS = (
    (r"(?i)-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----", f"[private key {REDACTED}]"),
    (r"(?i)eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]*", f"[token {REDACTED}]"),
    (r"(?i)\bBearer\s+[A-Za-z0-9\-\._~\+/]+=*", f"Bearer [token {REDACTED}]"),
    (r"(?i)(?:[A-Za-z][A-Za-z0-9 _\.]{1,40}=[^;]{0,200};\s*){2,}", f"[connection string {REDACTED}] "),
    (r"(?i)\b(password|pwd|user\s*id|uid|client[_\s]?secret|access[_\s]?token|api[_\s]?key|secret)\s*=\s*[^;,\s\"]*", f"$1={REDACTED}"),
)

#: What every match of the pattern in the same place holds, in lower case. A search for fixed text is far quicker
#: than the expression, and most texts hold none; a replacement brings in none that wasn't there.
SECRET_SIGNS = (("-----begin ", "private key-----"), ("eyj", "."), ("bearer",), ("=", ";"), ("=",))


def joined(*parts: Column | str) -> Column:
    """Concatenation in which null counts as empty. Strings are literals."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def truncate_utf8(text: Column, cap: int | Column) -> Column:
    """struct(content, original_bytes, final_bytes, truncated) of a text of at most cap UTF-8 bytes.

    A longer text is cut at a code-point boundary and ends with a mark that says so; both fit the cap
    unless the mark alone is longer. Null counts as empty.
    """
    if isinstance(cap, int):
        if cap <= 0:
            raise ValueError("the cap must be positive")
        cap = F.lit(cap)
    t = F.coalesce(text, F.lit(""))
    raw = t.cast("binary")
    size = F.octet_length(t)
    first, middle, last = TRUNCATION_MARK.format(cap="\x00", size="\x00").split("\x00")
    mark = F.concat(F.lit(first), cap.cast("string"), F.lit(middle), size.cast("string"), F.lit(last))
    room = F.greatest(cap - F.octet_length(mark), F.lit(0))
    # a cut before a continuation byte (10xxxxxx) would split a code point: go back three bytes at most
    inner = lambda at: F.conv(F.hex(F.substring(raw, at + 1, F.lit(1))), 16, 10).cast("int").bitwiseAND(F.lit(0xC0)) == 0x80
    cut = F.when((room == 0) | ~inner(room), room).when(~inner(room - 1), room - 1).when(~inner(room - 2), room - 2).otherwise(room - 3)
    short = F.concat(F.substring(raw, F.lit(1), cut).cast("string"), mark)
    out = F.when(size <= cap, t).otherwise(short)
    return F.struct(out.alias("content"), size.alias("original_bytes"), F.octet_length(out).alias("final_bytes"), (size > cap).alias("truncated"))


def fitted(df: DataFrame, content: str, content_cap: int, item_cap: int, margin: int) -> DataFrame:
    """Items of which none is larger, as JSON, than item_cap bytes: df with content cut, and original_bytes,
    final_bytes, truncated, item_bytes and skipped (why an item can't be sent, else null).

    The content is first cut to content_cap. If the whole item is then larger than item_cap less the margin,
    the content is cut once more by what is measured to be too much; an item that has no room for content,
    or is still too large, is skipped.
    """
    others = [c for c in df.columns if c != content]
    size = lambda c: F.octet_length(F.to_json(F.struct(*others, c.alias(content))))
    d = df.withColumn("_a", truncate_utf8(F.col(content), content_cap)).withColumn("_size", size(F.col("_a.content")))
    over = F.col("_size") > item_cap - margin
    budget = F.col("_a.final_bytes") - (F.col("_size") - (item_cap - margin))
    d = d.withColumns({"_over": over, "_budget": budget})
    d = d.withColumn("_b", F.when(F.col("_over") & (F.col("_budget") > 0), truncate_utf8(F.col("_a.content"), F.col("_budget"))))
    last = F.when(F.col("_over"), F.col("_b.content")).otherwise(F.col("_a.content"))
    d = d.withColumn("_last", last).withColumn("item_bytes", F.when(F.col("_last").isNotNull(), size(F.col("_last"))))
    why = F.when(F.col("_last").isNull(), "no room for content").when(F.col("item_bytes") > item_cap, "too large")
    d = d.withColumn("skipped", why)
    shown = F.when(F.col("skipped").isNull(), F.col("_last"))
    return d.select(*others, shown.alias(content), F.col("_a.original_bytes").alias("original_bytes"), F.octet_length(shown).alias("final_bytes"), (F.col("_a.truncated") | F.col("_over")).alias("truncated"), "item_bytes", "skipped")


@F.pandas_udf(T.StringType())
def decode_entities(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """HTML character references to characters; Spark has no built-in for the named ones."""
    for s in batches:
        yield s.map(lambda x: html.unescape(x) if isinstance(x, str) and "&" in x else x)


def strip_markup(markup: Column, entities: bool = True) -> Column:
    """Prose of a page: scripts, styles and tags out, entities decoded, white space as single blanks."""
    t = F.regexp_replace(F.coalesce(markup, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</\1>", " ")
    t = F.regexp_replace(t, r"(?s)<[^>]+>", " ")
    if entities:
        t = decode_entities(t)
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def _signed(lower: Column, signs: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, (F.contains(lower, F.lit(s)) for s in signs))


def scrub(text: Column) -> Column:
    """Text with keys, tokens, connection strings and credentials redacted."""
    # a list of one element gives the text of a step a name, so no step is written out twice
    step = lambda pattern, instead, signs: lambda t: F.when(_signed(F.lower(t), signs), F.regexp_replace(t, pattern, instead)).otherwise(t)
    held = F.array(text)
    for (pattern, instead), signs in zip(SECRET_PATTERNS, SECRET_SIGNS):
        held = F.transform(held, step(pattern, instead, signs))
    return F.get(held, F.lit(0))


def needs_scrubbing(text: Column) -> Column:
    found, lower = F.lit(False), F.lower(text)
    for (pattern, _), signs in zip(SECRET_PATTERNS, SECRET_SIGNS):
        found = found | F.coalesce(_signed(lower, signs) & text.rlike(pattern), F.lit(False))
    return found


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(path: Column) -> Column:
    """In lower case with its dot; empty if the name has none."""
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1))


def folder(path: Column) -> Column:
    return F.regexp_replace(path, r"/[^/]*$", "")


def qualified_name(name: Column) -> Column:
    """struct(database, object, cluster) of database.object@cluster: the last @, the first dot."""
    left = F.when(name.contains("@"), F.regexp_extract(name, r"(?s)^(.*)@[^@]*$", 1)).otherwise(name)
    cluster = F.when(name.contains("@"), F.regexp_extract(name, r"@([^@]*)$", 1)).otherwise(F.lit(""))
    dotted = left.contains(".")
    return F.struct(
        F.when(dotted, F.substring_index(left, ".", 1)).otherwise(left).alias("database"),
        F.when(dotted, F.regexp_extract(left, r"(?s)^[^.]*\.(.*)$", 1)).otherwise(F.lit("")).alias("object"),
        cluster.alias("cluster"),
    )


def table_name(name: Column) -> Column:
    """struct(database, table); the database is default unless there are exactly two parts."""
    parts = F.split(name, r"\.")
    two = F.size(parts) == 2
    return F.struct(F.when(two, parts[0]).otherwise(F.lit("default")).alias("database"), F.when(two, parts[1]).otherwise(name).alias("table"))


def key_values(text: Column) -> Column:
    """map of a=b;c=d; parts are trimmed, those without = or a key are left out, the last of a key counts."""
    pairs = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x.rlike(r"^[^=]*\S[^=]*="))
    split = F.transform(pairs, lambda x: F.struct(F.trim(F.substring_index(x, "=", 1)).alias("k"), F.trim(F.regexp_extract(x, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))
    last = F.filter(split, lambda x, i: ~F.exists(F.slice(split, i + 2, F.greatest(F.size(split) - i - 1, F.lit(0))), lambda y: y["k"] == x["k"]))
    return F.map_from_entries(last)


def tags(text: Column, separator: str = ",") -> Column:
    """Trimmed, non-blank parts; null if none is left."""
    out = F.filter(F.transform(F.split(text, separator), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(out) > 0, out)


def item_key(prefix: str, key: Column, most: int = 100) -> Column:
    """A prefix and the ASCII letters and digits of a key."""
    return F.concat(F.lit(prefix), F.substring(F.regexp_replace(key.cast("string"), "[^A-Za-z0-9]", ""), 1, most))


def from_template(template: str, key: Column) -> Column:
    """A URL template whose {0} is the key."""
    if "{0}" not in template:
        raise ValueError("a URL template must contain {0}")
    before, _, after = template.partition("{0}")
    return F.concat(F.lit(before), key.cast("string"), F.lit(after))


def compact_count(n: Column) -> Column:
    """999, 1.2k, 3.4M, 5.6B."""
    short = lambda d, unit: F.concat(F.format_string("%.1f", F.round(n / d, 1)), F.lit(unit))
    return F.when(n < 1000, n.cast("string")).when(n < 1_000_000, short(1e3, "k")).when(n < 1_000_000_000, short(1e6, "M")).otherwise(short(1e9, "B"))


def compact_bytes(n: Column) -> Column:
    short = lambda d, unit: F.concat(F.format_string("%.1f", F.round(n / d, 1)), F.lit(unit))
    return F.when(n < 1024, F.concat(n.cast("string"), F.lit(" B"))).when(n < 1 << 20, short(1024.0, " KB")).when(n < 1 << 30, short(float(1 << 20), " MB")).otherwise(short(float(1 << 30), " GB"))


def duration(seconds: Column) -> Column:
    """5s, 2m 3s, 4h 5m."""
    s = lambda x: x.cast("string")
    m, h = F.floor(seconds / 60), F.floor(seconds / 3600)
    return (
        F.when(seconds < 60, F.concat(s(seconds), F.lit("s")))
        .when(seconds < 3600, F.concat(s(m), F.lit("m "), s(seconds % 60), F.lit("s")))
        .otherwise(F.concat(s(h), F.lit("h "), s(m % 60), F.lit("m")))
    )


def age(minutes: Column) -> Column:
    """never, 5m, 3h, 2d."""
    s = lambda d, u: F.concat(F.floor(minutes / d).cast("string"), F.lit(u))
    return F.when(minutes.isNull(), "never").when(minutes < 60, s(1, "m")).when(minutes < 1440, s(60, "h")).otherwise(s(1440, "d"))
