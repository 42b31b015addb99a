"""Quality rules, lines first, in DataFrame functions only.

Every line is held against the rules for punctuation, navigation, symbols and
boilerplate; lines that fail are removed, and a document that loses too much of
its text, or fails the base rules as a whole, is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.llm.common import as_row, let

BLANKS = " \t\n\x0b\x0c\r"
BLANK = r"[\x20\x09-\x0D]"
SYMBOL = "[#*$%&|<>]"
WINDOW = 3
MIN_WORDS = 50
#: A document is rejected when words in repeated windows are over this share of its words, in percent.
MAX_REPEATED = 50
#: A document is rejected when fewer than this share of its words is left, in percent.
MIN_LEFT = 50
#: A line is navigation when it has at least two separators and one for every so many of its words.
WORDS_PER_SEPARATOR = 4
#: A line fails when more than this share of its characters are symbols, in percent.
MAX_SYMBOLS = 10

#: Marks that end a sentence, with what may close after them.
SENTENCE_END = r"[.!?:;。！？…]"
CLOSED = SENTENCE_END + "[\"'”’»)\\]]*$"
WITHIN = SENTENCE_END + "[\"'”’»)\\]]*" + BLANK
SEPARATORS = ("|", ">", "»", "›", "•", "·", "/", "::", "--")
#: Other ends of a line that a word may hold behind a separator.
LINE_ENDS = ("", "\x85", "\u2028", "\u2029")
BOILERPLATE = (
    r"(?i)(cookie|javascript|lorem ipsum|privacy policy|terms of (use|service)|all rights reserved|"
    r"copyright (\(c\)|©|[0-9]{4})|licen[sc]ed under|released under the|newsletter|(sign|log) ?(in|up) (to|now|here))"
)

#: Bits of a window's place in the sorted list; the rest are of its hash.
_PLACE = 30


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK + "+"))


def _twice(ordered: Column, key) -> Column:
    """Items of a sorted list whose key the item before or after has too."""
    same = lambda x, other: F.coalesce(key(x) == key(other), F.lit(False))
    return F.filter(ordered, lambda x, i: same(x, F.get(ordered, i - 1)) | same(x, F.get(ordered, i + 1)))


def _repeated(words: Column) -> Column:
    """Words in windows of three that the text has twice or more.

    Windows are sorted by a hash with the place in its low bits; those that
    meet another are compared in full, so equal hashes alone count nothing.
    """
    low = (1 << _PLACE) - 1
    starts = F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))
    hashed = F.transform(starts, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).bitwiseAND(F.lit(~low)).bitwiseOR(i.cast("long")))
    suspects = let(F.sort_array(hashed), lambda s: _twice(s, lambda x: F.shiftright(x, _PLACE)))
    place = lambda x: x.bitwiseAND(F.lit(low)).cast("int")
    full = F.transform(suspects, lambda x: F.struct(F.slice(words, place(x) + 1, WINDOW).alias("w"), place(x).alias("at")))
    at = let(F.sort_array(full), lambda s: F.sort_array(F.transform(_twice(s, lambda x: x.w), lambda x: x["at"])))
    covered = lambda p: F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
    return let(at, lambda p: F.aggregate(covered(p), F.lit(0).cast("long"), lambda a, x: a + x))


def base_measures(text: Column) -> Column:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of a whole text; NULL is an empty text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    return let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated(w).alias("n_repeat_words"),
        ),
    )


def line_fails(line: Column) -> Column:
    """The rule that a line with words fails, or NULL."""

    def rule(words: Column) -> Column:
        separators = F.size(F.filter(words, lambda w: w.isin([s + e for s in SEPARATORS for e in LINE_ENDS])))
        end = F.btrim(line, F.lit(BLANKS))
        symbols = F.length(end) - F.length(F.regexp_replace(end, SYMBOL, ""))
        return (
            F.when((separators >= 2) & (separators * WORDS_PER_SEPARATOR >= F.size(words)), "navigation")
            .when(symbols * 100 > F.length(end) * MAX_SYMBOLS, "symbols")
            .when(end.rlike(BOILERPLATE), "boilerplate")
            .when(~end.rlike(CLOSED) & ~end.rlike(WITHIN), "punctuation")
        )

    return let(_words(line), rule)


def cleaned(text: Column) -> Column:
    """``text`` without the lines that fail, ``n_lines`` with words, ``n_failed`` of them, ``words_left``.

    Lines without words stay where they are.
    """
    judged = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(x.alias("line"), (F.btrim(x, F.lit(BLANKS)) != "").alias("full"), line_fails(x).alias("rule")))

    def summed(lines: Column) -> Column:
        keeps = lambda x: ~x.full | x.rule.isNull()
        left = F.array_join(F.transform(F.filter(lines, keeps), lambda x: x.line), "\n")
        return let(
            left,
            lambda t: F.struct(
                t.alias("text"),
                F.size(F.filter(lines, lambda x: x.full)).cast("long").alias("n_lines"),
                F.size(F.filter(lines, lambda x: ~keeps(x))).cast("long").alias("n_failed"),
                F.size(_words(t)).cast("long").alias("words_left"),
            ),
        )

    return let(judged, summed)


def _base_failed(base: Column) -> Column:
    return (base.n_words < MIN_WORDS) | (base.n_repeat_words * 100 > base.n_words * MAX_REPEATED)


def _kept(base: Column, lines: Column) -> Column:
    return ~_base_failed(base) & (lines.words_left * 100 >= base.n_words * MIN_LEFT)


def assessed(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``(row, base, lines, base_failed, kept)`` for every row.

    ``row`` has the document's columns (or those of ``keep``), ``base`` and
    ``lines`` the figures above. NULL, empty and blank texts have no words and
    fail the base rules. Repeated rows and ids are judged row by row; columns
    other than ``text`` are only carried; no rows give no rows.
    """
    read = docs.select(as_row(keep or docs.columns), base_measures(F.col("text")).alias("base"), cleaned(F.col("text")).alias("lines"))
    base, lines = F.col("base"), F.col("lines")
    return read.select("*", _base_failed(base).alias("base_failed"), _kept(base, lines).alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    """The figures of each document and the verdict."""
    out = assessed(docs, keep=["doc_id"])
    return out.select("row.doc_id", "base.*", "base_failed", "kept", "lines.n_lines", "lines.n_failed", "lines.words_left")


def clean(docs: DataFrame) -> DataFrame:
    """The documents kept, without the lines that failed, in their own columns; ``n_chars`` is that of the new text."""
    # A filter over the measures would be pushed below them and work them out twice; an exploded list of one or none does not.
    judged = F.array(F.struct(base_measures(F.col("text")).alias("base"), cleaned(F.col("text")).alias("lines")))
    out = docs.select(as_row(docs.columns), F.explode(F.filter(judged, lambda v: _kept(v.base, v.lines))).alias("out")).select("row", "out.lines")
    new = {"text": F.col("lines.text"), "n_chars": F.length("lines.text").cast("long")}
    return out.select(*[(new[c] if c in new else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
