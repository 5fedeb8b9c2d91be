"""Text expressions (FN-1 to FN-4). All stay inside Catalyst."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the flag that marks an article.
ARTICLE_FLAG = "ART"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def split_words(text: Column | str) -> Column:
    """Split on single spaces, without trailing empty words.

    Leading and inner empty words stay. Empty text is one empty word; text of spaces only is no
    word. Tabs and newlines are part of a word. Null gives null, so exploding it gives no rows.
    """
    text = as_column(text)
    return _words(text, text)


def lower_words(text: Column | str) -> Column:
    """Words of the lower-cased text; the case rule does not depend on the host's locale."""
    text = as_column(text)
    return _words(text, F.lower(text))


def _words(text: Column, shown: Column) -> Column:
    """Words of ``shown``, a form of ``text`` with the same spaces.

    Written so that each form is computed once; only text that starts with a space is trimmed
    twice. Splitting empty text gives the one empty word.
    """
    only_spaces = text.startswith(" ") & (F.rtrim(text) == "")
    none = F.array().cast("array<string>")
    return F.when(only_spaces, none).otherwise(F.split(F.rtrim(shown), " "))


def is_article(flags: Column | str = "flags") -> Column:
    """True where the flags contain the article mark. Null flags are null, so not kept."""
    return as_column(flags).contains(ARTICLE_FLAG)


def lines(items: Column | str) -> Column:
    """One item per line, with a newline after the last too. No items give empty text."""
    items = as_column(items)
    joined = F.array_join(items, "\n", "null")
    return F.when(F.size(items) > 0, F.concat(joined, F.lit("\n"))).otherwise(F.lit(""))
