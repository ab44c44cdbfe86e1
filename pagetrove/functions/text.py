"""Text functions as Column expressions; all of them stay inside the JVM."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() and str.strip() treat as white space, as the
# inside of a regular-expression class. Java's own \s covers only six of them.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Fixed value: width of the star rulers in reports.
RULER = 40


def strip_text(text: Column) -> Column:
    """Drop white space, Unicode included, at both ends (Spark's ``trim`` drops blanks only)."""
    return F.regexp_replace(text, rf"^[{WHITESPACE}]+|[{WHITESPACE}]+\z", "")


def clean_text(text: Column) -> Column:
    """Remove URLs, then turn every run of white space into one blank and trim.

    A URL ends at white space of any kind, so line breaks need no step of their own.
    """
    without_urls = F.regexp_replace(text, rf"http[^{WHITESPACE}]+", "")
    return F.trim(F.regexp_replace(without_urls, rf"[{WHITESPACE}]+", " "))


def clean_pages(pages: Column) -> Column:
    """``clean_text`` on every element of an array of page texts."""
    return F.transform(pages, clean_text)


def tokens(text: Column) -> Column:
    """Blank-separated words of a cleaned text; blank or null text has none."""
    cleaned = clean_text(text)
    return F.array_remove(F.split(cleaned, " "), "")


def html_text(html: Column) -> Column:
    """Visible text of a web page: scripts, styles, comments and tags become blanks."""
    no_blocks = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>", " ")
    return clean_text(F.regexp_replace(no_blocks, r"(?s)<!--.*?-->|<[^>]*>", " "))


def base_name(path: Column) -> Column:
    """Last component of a path; both kinds of slash separate."""
    return F.regexp_extract(path, r"[^/\\]*\z", 0)


# A base name with an extension: something other than dots, then the last dot and what follows.
_NAME_PARTS = r"(?s)^(.*[^.].*)(\.[^.]*)\z"


def stem(path: Column) -> Column:
    """Base name without its last extension; leading dots start no extension."""
    return F.regexp_replace(base_name(path), _NAME_PARTS, "$1")


def extension(path: Column) -> Column:
    """Last extension with its dot, or the empty string."""
    return F.regexp_extract(base_name(path), _NAME_PARTS, 2)


def swap_extension(path: Column, old: str, new: str) -> Column:
    """Base name with a trailing ``old`` extension replaced by ``new``; case is ignored."""
    escaped = old.replace(".", r"\.")
    return F.regexp_replace(base_name(path), rf"(?i){escaped}\z", new)


def report_name(path: Column) -> Column:
    """Name of a page report: ``<stem>_output``."""
    return F.concat(stem(path), F.lit("_output"))


def has_suffix(path: Column, suffix: str = ".pdf") -> Column:
    """True if the path ends in the suffix, whatever the case."""
    return F.lower(path).endswith(suffix.lower())


def page_block(number: Column, text: Column) -> Column:
    """A page as it stands in a report: ruler with the page number from 1, then the stripped text."""
    ruler = F.repeat(F.lit("*"), RULER)
    return F.concat(
        F.lit("\n"), ruler, F.format_string(" Page %d ", number), ruler, F.lit("\n"),
        strip_text(text), F.lit("\n"),
    )


def chunk_block(number: Column, page: Column, text: Column) -> Column:
    """A chunk as it stands in a report: ruler with the chunk number from 1 and its page."""
    ruler = F.repeat(F.lit("*"), RULER)
    return F.concat(
        F.lit("\n"), ruler, F.format_string(" Chunk %d ", number), ruler,
        F.format_string(" Page: %d\n", page), strip_text(text), F.lit("\n"),
    )


def page_metadata(source: Column, page: Column) -> Column:
    """Metadata of a page as JSON text, the form in which a collection stores it."""
    return F.to_json(F.struct(source.alias("source"), page.alias("page")))


def metadata_variant(metadata: Column) -> Column:
    """JSON metadata as a VARIANT, parsed once; null where the text is no JSON."""
    return F.try_parse_json(metadata)


def metadata_field(metadata: Column, key: str, as_type: str = "string") -> Column:
    """One top-level field of JSON metadata, null where the key is missing."""
    return F.get_json_object(metadata, f"$.{key}").cast(as_type)
