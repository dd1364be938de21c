"""Documents that are already in a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.operators.classify import status_of

#: Bytes behind a piece that are searched for the end of its last token at first.
_LOOK_AHEAD = 4096

# Fixed value: the tokens that a text begins with, without backtracking.
_LEADING = r"^\p{Alnum}*+"


def _leading(content: Column) -> Column:
    """The token characters that bytes begin with."""
    return F.regexp_extract(F.decode(content, "ISO-8859-1"), _LEADING, 0)


def _cut(content: Column, number: Column, piece_bytes: int) -> Column:
    """Piece ``number`` of a text in bytes, as text.

    Pieces are cut every ``piece_bytes`` and then moved to the end of the token
    they cut: the next piece leaves out the token characters it begins with, and
    this one takes them, however many there are. A piece inside one token is
    empty. Bytes become characters as ISO-8859-1, as in files: tokens are ASCII.
    """
    size = F.lit(piece_bytes)
    first = number * size + 1
    own = F.decode(F.substring(content, first, size), "ISO-8859-1")
    lead = F.when(number == 0, F.lit(0)).otherwise(F.length(F.regexp_extract(own, _LEADING, 0)))
    near = _leading(F.substring(content, first + size, F.lit(_LOOK_AHEAD)))
    rest = F.when(F.length(near) < _LOOK_AHEAD, near).otherwise(
        _leading(F.substring(content, first + size, F.octet_length(content)))
    )
    return F.when(lead == F.length(own), F.lit("")).otherwise(F.concat(F.substring(own, lead + 1, size), rest))


def corpus_from_table(
    documents: DataFrame,
    path: str = "path",
    text: str = "text",
    max_bytes: int | None = None,
    keep: Sequence[str] = (),
    piece_bytes: int | None = None,
) -> DataFrame:
    """View a table with one row per path as a corpus.

    A null text has no size and counts as inaccessible. ``keep`` carries
    further columns along, to group by. With ``piece_bytes`` a longer text is a
    row per piece, numbered from 0, that ends between tokens, so that what comes
    next never holds the tokens of a whole long text; otherwise a text is one
    piece, whatever its size.
    """
    size = F.octet_length(F.col(text)).cast("bigint")
    sized = documents.select(
        F.col(path).alias("path"),
        size.alias("size_bytes"),
        F.col(text).alias("text"),
        (F.lit(0) if piece_bytes is None else F.explode(_numbers(size, piece_bytes))).alias("piece"),
        *keep,
    )
    status = status_of("path", "size_bytes", max_bytes)
    content = F.col("text")
    if piece_bytes is not None:
        cut = _cut(F.col("text").cast("binary"), F.col("piece"), piece_bytes)
        content = F.when(F.col("size_bytes") > piece_bytes, cut).otherwise(content)
    return sized.select(
        "path",
        "size_bytes",
        status.alias("status"),
        F.lit(None).cast("string").alias("error"),
        content.alias("text"),
        "piece",
        *keep,
    )


def _numbers(size: Column, piece_bytes: int) -> Column:
    """Numbers of the pieces of a text; a null or empty one has number 0."""
    last = F.greatest(F.ceil(F.coalesce(size, F.lit(0)) / piece_bytes).cast("int") - 1, F.lit(0))
    return F.sequence(F.lit(0), last)
