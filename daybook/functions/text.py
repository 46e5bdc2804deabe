"""Plain text from documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: named character references and their text; the ampersand comes last
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def html_text(html: Column) -> Column:
    """Text of an HTML document: scripts, styles, comments and tags removed, white space collapsed."""
    text = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>", " ")
    text = F.regexp_replace(text, r"(?is)<style[^>]*>.*?</style>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    for reference, plain in ENTITIES:
        text = F.replace(text, F.lit(reference), F.lit(plain))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def document_text(name: Column, content: Column) -> Column:
    """Text of a document by its name's ending; a message naming the file where none can be read."""
    lower = F.lower(name)
    text = F.try_validate_utf8(content.cast("string"))
    readable = (
        F.when(lower.endswith(".html") | lower.endswith(".htm"), html_text(text))
        .when(lower.endswith(".txt"), text)
    )
    return F.coalesce(readable, F.concat(F.lit("No Text In CV With Filename: "), name))
