"""Predicates on chunks, sections, questions and answers, as column expressions."""

from __future__ import annotations

import re
from collections import deque
from functools import reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioquest.functions import fixed, text


TERM_LISTS = ("patterns", "short", "metadata", "citations")


def _term_lists(patterns: tuple[str, ...] | None) -> dict[str, tuple[str, ...]]:
    patterns = fixed.CHUNK_PATTERNS if patterns is None else patterns
    short = tuple(p.strip() for p in patterns if len(p.strip().split()) <= 3)
    return dict(zip(TERM_LISTS, (patterns, short, fixed.METADATA_TERMS, fixed.CITATION_TERMS), strict=True))


def _literals(terms: tuple[str, ...]) -> Column:
    return F.array(*map(F.lit, terms)).cast("array<string>")


def any_of(terms: list[str]) -> str:
    """A pattern for any of the terms, which shares their beginnings: one walk over a text tells whether it has any."""
    out = []
    for first, group in groupby(sorted(set(terms)), key=lambda t: t[:1]):
        rests = [t[1:] for t in group]
        # a term that ends here makes the longer ones needless
        out.append(re.escape(first) + ("" if "" in rests else any_of(rests)))
    return out[0] if len(out) == 1 else f"(?:{'|'.join(out)})"


def terms_in(content: Column, patterns: tuple[str, ...] | None = None) -> Column:
    """The terms of each list that a text contains. A document's are looked up once, and then only those in its pieces."""
    lists = _term_lists(patterns)
    every = [t for terms in lists.values() for t in terms if t]
    present = lambda lower: F.struct(*[F.filter(_literals(t), lambda x: F.contains(lower, x)).alias(name) for name, t in lists.items()])
    none = F.struct(*[_literals(tuple(x for x in t if not x)).alias(name) for name, t in lists.items()])
    return text.let(F.lower(content), lambda lower: F.when(lower.rlike(any_of(every)), present(lower)).otherwise(none) if every else none)


def quality_reasons(content: Column, patterns: tuple[str, ...] | None = None, terms: Column | None = None) -> Column:
    """Why a chunk is rejected, or null: short, patterns, newlines, metadata or citations. ``terms``: what ``terms_in`` gave for the text that the chunk is a part of."""
    lists = {name: terms[name] if terms is not None else _literals(t) for name, t in _term_lists(patterns).items()}
    n = F.length(content)
    counted = text.let(text.strip(F.lower(content)), lambda lower: F.struct(*[F.size(F.filter(t, lambda x: F.contains(lower, x))).alias(name) for name, t in lists.items()]))
    none = F.struct(*[F.lit(0).alias(name) for name in TERM_LISTS])
    any_terms = F.size(F.concat(*lists.values())) > 0

    def reasons(hits: Column) -> Column:
        return (
            F.when((hits["patterns"] >= 2) | (hits["short"] >= 3), "patterns")
            .when(text.count_of(content, "\n") / n > 0.1, "newlines")
            .when(hits["metadata"] >= F.when(n < 300, 1).otherwise(2), "metadata")
            .when((n < 300) & (hits["citations"] >= 2), "citations")
        )

    return F.when(n < 100, "short").otherwise(text.let(F.when(any_terms, counted).otherwise(none), reasons))


def good_chunks(chunks: DataFrame, column: str = "piece", patterns: tuple[str, ...] | None = None, terms: str | None = None) -> DataFrame:
    return chunks.where(quality_reasons(F.col(column), patterns, F.col(terms) if terms else None).isNull())


def _any(patterns: tuple[str, ...]) -> str:
    return "(?iuUd)" + "|".join(patterns)


def skipped_name(name: Column) -> Column:
    return name.rlike(_any(fixed.SKIP_SECTIONS))


def is_content_section(name: Column, content: Column) -> Column:
    return ~skipped_name(name) & (content.isNull() | (F.length(content) >= 50))


def is_front_matter(content: Column) -> Column:
    """Over three in ten of the lines that aren't blank look like front matter; a text of blank lines is, an empty one isn't."""
    lines = F.split(content, "\n")
    hits = F.size(F.filter(lines, lambda x: x.rlike(_any(fixed.FRONT_MATTER))))
    full = F.size(F.filter(lines, lambda x: text.strip(x) != ""))
    return F.when(F.coalesce(F.length(content), F.lit(0)) == 0, False).when(full == 0, True).otherwise(hits / full > 0.3)


def is_generic_question(question: Column) -> Column:
    lower = F.lower(question)
    few = F.size(text.words(lower)) - 2 < 5
    opener = lower.rlike("^(?:" + "|".join(fixed.GENERIC_OPENERS) + ")")
    phrase = reduce(lambda a, b: a | b, [lower.startswith(p) for p in fixed.GENERIC_PHRASES])
    return (F.length(question) < 20) | (opener & few) | (phrase & (F.length(lower) < 50))


def is_grounded(answer: Column) -> Column:
    """The reference's check: an answer that isn't blank."""
    return text.strip(answer) != ""


def grounding_score(answer: Column, context: Column) -> Column:
    """Share of the answer's words that the context has. Not part of the reference; opt in."""
    return text.overlap(text.word_set(answer), text.word_set(context), "candidate")


def wrong_polarity(kind: Column, asked_true: Column, answer: Column) -> Column:
    lower = F.lower(text.strip(answer))
    return (kind == "true-false") & F.when(asked_true, lower.startswith("falso")).otherwise(lower.startswith("verdadeiro"))


def normal_question(question: Column) -> Column:
    return F.rtrim(text.strip(F.lower(question)), F.lit("?"))


def first_of_each_question(questions: DataFrame, column: str, order: str) -> DataFrame:
    """The first row of each normalised question: aggregated before it is shuffled, so a question that all ask is no hot key."""
    keyed = questions.withColumn("norm", normal_question(F.col(column)))
    return keyed.groupBy("norm").agg(F.min_by(F.struct(*questions.columns), order).alias("r")).select("r.*", "norm")


#: How many accepted questions a new one is compared with, and which of them: about as long, with over 0.9 of its words.
RECENT, LENGTH_APART, SAME_WORDS = 20, 0.3, 0.9


def new_questions(norms: list[str]) -> list[bool]:
    """Fold in order: a question stays unless it is one that stayed, or nearly one of the last ``RECENT`` that did."""
    seen: set[str] = set()
    recent: deque[tuple[int, frozenset[str]]] = deque(maxlen=RECENT)
    out = []
    for own in norms:
        words = frozenset(own.split())
        near = (w for n, w in recent if abs(n - len(own)) <= LENGTH_APART * len(own))
        new = own not in seen and not any(len(words & w) / max(len(words), 1) > SAME_WORDS for w in near)
        out.append(new)
        if new:
            seen.add(own)
            recent.append((len(own), words))
    return out


def accepted_questions(questions: DataFrame, column: str, order: str, key: str) -> DataFrame:
    """The questions that stay, with ``norm``, folded in order within each key: what stays depends on what stayed before, so a key's questions are one task's."""
    keyed = questions.withColumn("norm", normal_question(F.col(column)))

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        return table.filter(pa.array(new_questions([n or "" for n in table.column("norm").to_pylist()]), pa.bool_()))

    return keyed.groupBy(key).applyInArrow(fold, keyed.schema)
