"""WARC derivative builder: metadata and plain-text conversion records from responses.

Every response gives two derived records that refer to it and to each other: a
``metadata`` record (source headers, title, digests) and a ``conversion`` record (the
page's visible text). DataFrame functions only; rows are independent, so no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRLF = "\r\n"
VERSION = "WARC/1.1"
#: Date given to responses whose source table has none.
DATE = "2024-01-01T00:00:00Z"

#: The named character references that are decoded.
ENTITIES = {
    "amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "reg": "®", "hellip": "…", "mdash": "—", "ndash": "–",
    "lsquo": "‘", "rsquo": "’", "ldquo": "“", "rdquo": "”", "laquo": "«", "raquo": "»", "euro": "€", "middot": "·", "bull": "•",
}
#: Elements whose content is no text, and elements that end a line.
HIDDEN = ("script", "style", "noscript", "template")
BREAKING = "address|article|aside|blockquote|body|br|dd|div|dl|dt|figure|footer|form|h1|h2|h3|h4|h5|h6|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul"
#: Runs of blanks that are not one space; tags that break a line; comments, hidden elements and all other tags.
BLANKS = r"[\x09-\x0D][\x09-\x0D\x20]*|\x20[\x09-\x0D\x20]+"
#: The same, with one test of a character that is no blank.
BLANKS_ONCE = r"[\t\n\x0B\f\r ](?:[\t\n\x0B\f\r ]++|(?<! ))"
BREAKS = rf"(?i)</?(?:{BREAKING})(?:[ /][^>]*)?>"
UNSEEN = "(?is)<(?:!--.*?-->|" + "|".join(rf"{tag}\b.*?</{tag}[^>]*>" for tag in HIDDEN) + "|[a-z/!?][^>]*>)"
#: Line ends with blanks about them, or several.
LINES = " +\n[ \n]*|\n[ \n]+"
#: The same, tried once a run of blanks, with one test of a character that is neither.
LINES_ONCE = "[ \n](?:(?<= )(?<!  ) *+\n[ \n]*+|(?<=\n)[ \n]++)"
#: A title, tried at the last of several openers before a ``>``; the others would find the same.
TITLE = "(?is)<title(?:[^<>]|<(?!title))*+>([^<]*+)</title"
#: What a comment or hidden element begins with, and how many searches for a missing end are cheaper than looking for it first.
OPENERS = "(?i)<(?:!--|" + "|".join(HIDDEN) + ")"
FEW = 16
#: Noncharacters, of which one that a page does not have marks openers without an end.
MARKS = "\ufdd0\ufdd1\ufdd2\ufdd3"
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]{2,8});"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def base32_sha1(data: Column) -> Column:
    """``sha1:`` and the digest in base 32, as WARC tools write it."""
    part = lambda d, at: F.lpad(F.conv(F.substring(d, at, 10), 16, 32), 8, "0")
    digits = F.upper(_bind(F.sha1(data), lambda d: F.concat(*[part(d, at) for at in (1, 11, 21, 31)])))
    return F.concat(F.lit("sha1:"), F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def record_id(name: Column) -> Column:
    """A urn:uuid that depends on ``name`` alone, so reruns give the same ids."""
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), _bind(F.md5(name), lambda h: F.concat_ws("-", *[F.substring(h, a, n) for a, n in parts])), F.lit(">"))


def _character(reference: Column) -> Column:
    """The character of one reference; the reference itself where it has none."""
    body = F.substring(reference, F.lit(2), F.length(reference) - 2)
    hexes = F.lower(F.substring(body, 1, 2)) == "#x"
    point = F.when(hexes, F.conv(F.substring(body, F.lit(3), F.length(body)), 16, 10)).otherwise(F.substring(body, F.lit(2), F.length(body))).cast("bigint")
    valid = point.between(1, 0x10FFFF) & ~point.between(0xD800, 0xDFFF)
    coded = F.decode(F.unhex(F.lpad(F.hex(F.when(valid, point).otherwise(63)), 8, "0")), "UTF-32")
    names = F.create_map(*[F.lit(x) for pair in ENTITIES.items() for x in pair])
    return F.when(body.startswith("#"), F.when(valid, coded).otherwise(reference)).otherwise(F.coalesce(F.try_element_at(names, body), reference))


def unescape(text: Column) -> Column:
    """Character references replaced once, left to right."""

    def decoded(t: Column) -> Column:
        found = F.transform(F.regexp_extract_all(t, F.lit(REFERENCE), F.lit(0)), _character)
        parts = F.zip_with(F.split(t, REFERENCE, -1), F.array_append(found, F.lit("")), lambda a, b: F.concat(a, b))
        return F.when(t.contains("&"), F.array_join(parts, "")).otherwise(t)

    return _bind(text, decoded)


def _after(text: Column, end: str) -> Column:
    """What follows the last ``end``; all of it if there is none."""
    return F.substring_index(text, end, -1)


def _before(text: Column, rest: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - F.length(rest))


def _marked(text: Column, opener: str, end: str, mark: Column) -> Column:
    """``text`` with the mark inside every opener that stands after the last end, so that no search for an end starts
    there. It can still be an ordinary tag."""

    def split(t: Column) -> Column:
        tail = F.regexp_replace(t, f"(?is)^.*{end}", "")
        return _bind(tail, lambda x: F.concat(_before(t, x), F.regexp_replace(x, f"(?i)<({opener[0]})(?={opener[1:]})", F.concat(F.lit("<$1"), mark))))

    return _bind(text, split)


def _unseen_removed(text: Column) -> Column:
    """``text`` without comments, hidden elements and tags, in time linear in its length: unless there are ``FEW`` openers,
    those whose end is missing are marked first, so that every search for an end finds one, and what it has passed over is gone."""

    def marked(t: Column, mark: Column) -> Column:
        for opener, end in _ENDS.items():
            t = _marked(t, opener, end, mark)
        return F.replace(F.regexp_replace(t, UNSEEN, ""), mark, F.lit(""))

    def removed(t: Column) -> Column:
        def any_unclosed(low: Column) -> Column:
            found = _after(t, "-->").contains("<!--")
            for tag in HIDDEN:
                found |= _after(low, f"</{tag}").contains(f"<{tag}")
            return found

        mark = F.lit(MARKS[-1])
        for c in MARKS[:-1]:
            mark = F.when(~t.contains(c), F.lit(c)).otherwise(mark)
        unclosed = (F.regexp_count(t, F.lit(OPENERS)) > FEW) & _bind(F.lower(t), any_unclosed)
        return F.when(unclosed, _bind(mark, lambda m: marked(t, m))).otherwise(F.regexp_replace(t, UNSEEN, ""))

    return _bind(text, removed)


#: Openers and what ends them.
_ENDS = {"!--": "-->", **{rf"{tag}\b": f"</{tag}" for tag in HIDDEN}}


def _tagged_part(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` on the text up to its last ``>``: all tags end there, and behind it a search for an end would find none."""

    def split(t: Column) -> Column:
        rest = F.when(t.contains(">"), _after(t, ">")).otherwise(t)
        return _bind(rest, lambda r: F.concat(use(_before(t, r)), r))

    return _bind(text, split)


def plain_text(html: Column) -> Column:
    """The visible text: comments, hidden elements and tags removed, blocks on lines of their own, references decoded, blanks folded.

    Linear in the page's length, also for pages of nothing but openers."""
    out = _tagged_part(F.regexp_replace(html, BLANKS_ONCE, " "), lambda t: F.regexp_replace(t, BREAKS, "\n"))
    out = unescape(_tagged_part(out, _unseen_removed))
    return F.btrim(F.regexp_replace(out, LINES_ONCE, "\n"), F.lit(" \n"))


def responses_from_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = DATE) -> DataFrame:
    """Response records of crawled pages: ``record_id``, ``target_uri``, ``warc_date``, ``http_headers``,
    ``payload_digest``, ``payload``.

    The record id depends on the page's id, address and content's digest, so equal rows give equal records.
    A null page has an empty payload, a null address none.
    """
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col), F.col(url_col).alias("target_uri"), payload.alias("payload")).withColumn("payload_digest", base32_sha1(F.col("payload")))
    payload = F.col("payload")
    name = F.concat_ws("\n", F.lit("response"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.coalesce(F.col("target_uri"), F.lit("null")), F.col("payload_digest"))
    headers = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.octet_length(payload).cast("string"), F.lit(CRLF))
    return rows.select(F.col(id_col), record_id(name).alias("record_id"), "target_uri", F.lit(date).alias("warc_date"), headers.alias("http_headers"), "payload_digest", "payload")


def derive(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Two records for every response: ``metadata`` and ``conversion``.

    ``responses`` has ``record_id``, ``target_uri``, ``warc_date``, ``http_headers``, ``payload_digest`` and ``payload``. Results:
    the ``keep`` columns, ``warc_type``, ``record_id``, ``refers_to`` (the response), ``concurrent_to`` (the other
    derived record), ``target_uri``, ``warc_date``, ``content_type``, ``content_length``, ``block_digest``,
    ``payload_digest`` (of the response's payload, as it was), ``block`` and ``record`` (the whole record without its
    closing blank lines; see ``write``). Null payloads count as empty, a null address or header block is left
    out, null record ids are named by the payload, a null digest is computed. Repeated responses give repeated records; an empty
    table gives an empty result; other columns of the input are ignored unless in ``keep``.
    """
    keep = keep or []
    payload = F.coalesce(F.col("payload"), F.lit(""))
    source = F.coalesce(F.col("record_id"), record_id(payload))
    base = responses.select(
        *[F.col(c).alias(f"__keep_{c}") for c in keep],
        source.alias("refers_to"),
        F.col("target_uri"),
        F.col("warc_date"),
        F.coalesce(F.col("http_headers"), F.lit("")).alias("http_headers"),
        F.coalesce(F.col("payload_digest"), base32_sha1(payload)).alias("payload_digest"),
        F.octet_length(payload).alias("payload_bytes"),
        F.regexp_extract(payload, TITLE, 1).alias("title"),
        plain_text(payload).alias("text"),
    )
    meta_id, text_id = (record_id(F.concat(F.lit(f"{kind}\n"), F.col("refers_to"))) for kind in ("metadata", "conversion"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    fields = F.concat(
        F.when(F.col("http_headers") != "", F.concat(F.regexp_replace(F.regexp_replace(F.col("http_headers"), r"(?m)^", "source-header: "), "(?:source-header: )$", ""))).otherwise(""),
        line("source-payload-digest", F.col("payload_digest")),
        line("source-payload-length", F.col("payload_bytes").cast("string")),
        F.when(F.col("title") != "", line("title", F.trim(F.regexp_replace(unescape(F.col("title")), r"[\x09-\x0D\x20]+", " ")))).otherwise(""),
        line("text-length", F.octet_length("text").cast("string")),
    )
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), meta_id.alias("record_id"), text_id.alias("concurrent_to"), F.lit("application/warc-fields").alias("content_type"), fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), text_id.alias("record_id"), meta_id.alias("concurrent_to"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("text").alias("block")),
    )
    rows = base.withColumn("__kind", F.explode(kinds)).select("*", "__kind.*").drop("__kind", "text", "title")
    rows = rows.withColumn("content_length", F.octet_length("block").cast("bigint")).withColumn("block_digest", base32_sha1(F.col("block")))
    head = F.concat(
        F.lit(f"{VERSION}{CRLF}"),
        line("WARC-Type", F.col("warc_type")),
        line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Refers-To", F.col("refers_to")),
        line("WARC-Concurrent-To", F.col("concurrent_to")),
        F.coalesce(line("WARC-Target-URI", F.col("target_uri")), F.lit("")),
        F.coalesce(line("WARC-Date", F.col("warc_date")), F.lit("")),
        line("WARC-Block-Digest", F.col("block_digest")),
        line("Content-Type", F.col("content_type")),
        line("Content-Length", F.col("content_length").cast("string")),
    )
    return rows.select(
        *[F.col(f"__keep_{c}").alias(c) for c in keep],
        "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "warc_date", "content_type", "content_length", "block_digest", "payload_digest", "block",
        F.concat(head, F.lit(CRLF), F.col("block")).alias("record"),
    )


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write the records as WARC files: each ends with two line ends, as the format asks."""
    records.select("record").write.option("lineSep", CRLF + CRLF).option("compression", compression).text(path)
