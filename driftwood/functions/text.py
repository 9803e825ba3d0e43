"""Tokenizers.  Two on purpose:

* ``single_space_tokens`` splits on one space and keeps empty tokens
  (``'a  b'`` -> ``a, '', b``; ``''`` -> one empty token) - the text-stream tokenizer.
* ``whitespace_tokens`` splits on runs of whitespace and drops empties, like
  Python's ``str.split()`` - the review/shingle tokenizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.split() treats as whitespace, in code-point order.
WHITESPACE_CHARS = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _regex_class(chars: str) -> str:
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]"


WHITESPACE_CLASS = _regex_class(WHITESPACE_CHARS)


def lines_of(text: Column) -> Column:
    """Array of the lines of a text (split on ``\\n``)."""
    return F.split(text, "\n")


def single_space_tokens(line: Column) -> Column:
    return F.split(line, " ")


def whitespace_tokens(text: Column) -> Column:
    """Python ``str.split()``: runs of whitespace separate, no empty tokens; null text -> 'nan'.

    Every whitespace character is mapped to a space (``translate``, a char table),
    then split on the space and the empty strings removed - no regex, no lambda.
    """
    t = F.translate(F.coalesce(text, F.lit("nan")), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    return F.array_remove(F.split(t, " "), "")
