"""Column functions over text: normalising, classifying, decoding, bucketing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake import vocabulary as V


def words_pattern(terms: Iterable[str]) -> str:
    """A pattern that finds any of the terms as a whole word."""
    return r"\b(" + "|".join(terms) + r")\b"


def has_word(text: Column, terms: Iterable[str]) -> Column:
    """True when the text, case folded, holds one of the terms as a whole word."""
    return F.lower(text).rlike(words_pattern(terms))


def squeeze(text: Column) -> Column:
    """Runs of white space become one blank."""
    return F.regexp_replace(text, r"\s+", " ")


def normalize_location(raw: Column, default: str = "Unknown") -> Column:
    trimmed = squeeze(F.trim(F.coalesce(raw, F.lit(""))))
    return F.coalesce(F.nullif(trimmed, F.lit("")), F.lit(default))


# The named entities that ``unescape`` decodes, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def strip_markup(raw: Column, decode_entities: bool = False) -> Column:
    """Tags become blanks, blanks are squeezed; NULL becomes the empty string.

    Entities stay as they are unless ``decode_entities`` is set.
    """
    plain = F.regexp_replace(F.coalesce(raw, F.lit("")), r"<[^>]+>", " ")
    return F.trim(squeeze(unescape(plain) if decode_entities else plain))


def first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    """The value of the first condition that holds."""
    if not cases:
        return F.lit(default)
    (condition, value), *rest = cases
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def classify(text: Column, rules=V.ROLE_FAMILIES, default: str = V.ROLE_DEFAULT) -> Column:
    """Ordered keyword classifier: the first rule with a whole-word hit names the class."""
    return first_match([(has_word(text, terms), label) for label, terms in rules], default)


def decode(code: Column, labels: Mapping, default: object) -> Column:
    """Code to label; unknown codes and NULL get the default."""
    return first_match([(code == F.lit(key), label) for key, label in labels.items()], default)


def bucketize(value: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge the value does not exceed; the last label is the overflow."""
    return first_match([(value <= F.lit(e), l) for e, l in zip(edges, labels)], labels[-1])


def block_key(*parts: Column) -> Column:
    """Case-folded parts joined by a bar; equal keys mark the same posting elsewhere."""
    return F.concat_ws("|", *[F.lower(p) for p in parts])
