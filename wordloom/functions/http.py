"""Checks on raw HTTP responses."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEADER_END = "\r\n\r\n"


def status(doc: Column | str) -> Column:
    """Integer after the first blank; white space before it is skipped, NULL if there are no digits."""
    return F.regexp_extract(doc, r"^[^ ]* \s*([+-]?\d+)", 1).try_cast("int")


def header_end(doc: Column | str) -> Column:
    """Position of the blank line that ends the headers, looked for from the first blank; 0 if none."""
    doc = _column(doc)
    return F.position(F.lit(_HEADER_END), doc, F.instr(doc, F.lit(" ")))


def body(doc: Column | str) -> Column:
    """What follows the headers; NULL without a header end."""
    doc = _column(doc)
    return F.when(header_end(doc) > 0, F.substr(doc, header_end(doc) + len(_HEADER_END)))


def is_ok(doc: Column | str) -> Column:
    """True for an HTTP response with status 200 and complete headers, else False.

    The status is looked for in the headers first, where it nearly always is: a pattern is costly on whole
    pages. Only if white space fills them does the number stand in the body.
    """
    doc = _column(doc)
    is_http = F.lower(F.substring(doc, 1, 5)) == "http/"
    found = F.coalesce(status(_head(doc)), status(doc))
    return F.coalesce(is_http & (header_end(doc) > 0) & (found == 200), F.lit(False))


def head_has_nul(doc: Column | str) -> Column:
    """Whether the headers hold a NUL, where a response would end."""
    return F.contains(_head(_column(doc)), F.lit("\0"))


def _head(doc: Column) -> Column:
    """The headers with their end."""
    return F.substring(doc, F.lit(1), header_end(doc) + len(_HEADER_END) - 1)


def _column(doc: Column | str) -> Column:
    return F.col(doc) if isinstance(doc, str) else doc
