"""Dictionary mapping and keyword tagging."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from ledgerloom.functions import parsing, text

# A literal map is searched entry by entry, so longer ones go through a join
# (operators.values.map_values); likewise a long chain of conditions is slower
# to compile than one higher-order expression.
LITERAL_MAP_LIMIT = 64
CONDITION_CHAIN_LIMIT = 64
# More keywords than this are looked up by their grams, of so many characters.
KEYWORD_INDEX_LIMIT = 512
GRAM = 4


def literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def common_type(types: list[T.DataType]) -> T.DataType:
    """The type that holds values of all these types: their own, a number, or text."""
    if len(set(types)) == 1:
        return types[0]
    if any(isinstance(t, T.DecimalType) for t in types) and all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in types):
        return exact_type(types)
    if all(isinstance(t, T.NumericType) for t in types):
        return T.LongType() if all(isinstance(t, T.IntegralType) for t in types) else T.DoubleType()
    return T.StringType()


def exact_type(types: list[T.DataType]) -> T.DecimalType:
    """A decimal that holds every value of these types as it is."""
    sizes = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (19, 0) for t in types]
    whole, scale = max(w for w, _ in sizes), max(s for _, s in sizes)
    if whole + scale > 38:
        raise ValueError(f"no decimal holds {whole} digits before and {scale} behind the point")
    return T.DecimalType(whole + scale, scale)


def _type_of(value) -> T.DataType:
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.LongType()
    if isinstance(value, float):
        return T.DoubleType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, decimal.Decimal):
        _, digits, power = value.as_tuple()
        scale = max(0, -power)
        return T.DecimalType(max(len(digits) + max(0, power), scale), scale)
    if isinstance(value, dt.datetime):
        return T.TimestampType()
    if isinstance(value, dt.date):
        return T.DateType()
    raise ValueError(f"no mapping to values like {value!r}")


def _as(value, kind: T.DataType):
    """A Python value as the type wants it."""
    if isinstance(kind, T.StringType):
        return str(value)
    if isinstance(kind, T.DecimalType):
        return decimal.Decimal(value)
    return float(value) if isinstance(kind, T.DoubleType) else value


def _fits(key, kind: T.DecimalType) -> bool:
    """Whether a decimal type holds a number without rounding."""
    number = decimal.Decimal(str(key))
    if not number.is_finite():
        return False
    _, digits, power = number.normalize(decimal.Context(prec=100)).as_tuple()
    return -power <= kind.scale and len(digits) + power <= kind.precision - kind.scale


def _can_equal(key, kind: T.DataType) -> bool:
    """Whether a column of this type can hold the key: text is never equal to a number."""
    if isinstance(kind, T.BooleanType) or isinstance(key, bool):
        return isinstance(kind, T.BooleanType) and isinstance(key, bool)
    if isinstance(kind, T.NumericType):
        if not isinstance(key, (int, float, decimal.Decimal)):
            return False
        if isinstance(kind, T.DecimalType):
            return _fits(key, kind)
        return not (isinstance(kind, T.IntegralType) and key != int(key))
    return isinstance(_type_of(key), type(kind))


def typed_pairs(mapping: dict, kind: T.DataType, default=None) -> tuple[list[tuple], T.DataType]:
    """Entries that can apply to a column of type ``kind``, and the type of the mapped column.

    The type is settled by all values together with what unmapped rows keep, so
    it does not hang on how many entries there are or which of them occur.
    """
    pairs = [(k, v) for k, v in mapping.items() if k is not None and v is not None and k == k and _can_equal(k, kind)]
    values = [v for v in mapping.values() if v is not None]
    kept = kind if default is None else _type_of(default)
    target = common_type([kept, *map(_type_of, values)]) if values else common_type([kept])
    return [(_key(k, kind), _as(v, target)) for k, v in pairs], target


def _key(key, kind: T.DataType):
    """A key that can apply, as a column of the type holds it."""
    if isinstance(kind, T.IntegralType):
        return int(key)
    return decimal.Decimal(str(key)) if isinstance(kind, T.DecimalType) else key


def fallback(c: Column, kind: T.DataType, target: T.DataType, default=None) -> Column:
    """What unmapped rows hold, in the type of the mapped column."""
    if default is not None:
        return F.lit(_as(default, target)).cast(target)
    if isinstance(target, T.StringType) and not isinstance(kind, T.StringType):
        return parsing.to_text(c, kind)
    return c if kind == target else c.cast(target)


def map_value(c: Column, mapping: dict, default=None, kind: T.DataType = T.StringType()) -> Column:
    """Look up ``c``, a column of type ``kind``; keep it where unmapped, or use ``default`` if one is given."""
    pairs, target = typed_pairs(mapping, kind, default)
    rest = fallback(c, kind, target, default)
    if not pairs:
        return F.coalesce(rest, rest)
    entries = F.create_map(*[x for k, v in pairs for x in (F.lit(k).cast(kind), F.lit(v).cast(target))])
    return F.coalesce(F.try_element_at(entries, c), rest)


def standard_category(c: Column, mapping: dict | None = None, case: str | None = "upper") -> Column:
    """Strip, map exactly, then set the case."""
    out = text.strip(c)
    if mapping:
        out = map_value(out, mapping)
    return text.to_case(out, case)


# Payment states and the names the load uses for them.
STATUS_NAMES = {"completed": "Processed", "pending": "AwaitingSettlement"}


def normal_status(c: Column) -> Column:
    """Strip and lower the state, then rename the two known ones."""
    return map_value(F.lower(text.strip(c)), STATUS_NAMES)


def keyword_index(words: list[str], size: int = GRAM) -> dict[str, list[int]]:
    """For each gram the keywords to try, by their rank, where a text holds it.

    A keyword stands under that of its grams which the fewest keywords hold; one
    shorter than ``size`` stands under itself.
    """
    grams_of = [{w[at : at + size] for at in range(len(w) - size + 1)} or {w} for w in words]
    often = Counter(gram for grams in grams_of for gram in grams)
    out: dict[str, list[int]] = {}
    for rank, grams in enumerate(grams_of):
        out.setdefault(min(grams, key=lambda g: (often[g], g)), []).append(rank)
    return out


def _indexed_tag(pairs: list[tuple[str, str]]):
    """The tag of the last pair whose keyword a (lower-case) text holds, else null, as a function over Arrow batches.

    A text is cut into its grams once; only the keywords that stand under one of
    them are looked for, so the number of keywords hardly counts.
    """
    tags, words = [tag for tag, _ in pairs], [word for _, word in pairs]
    index = keyword_index(words)
    lengths = sorted({len(gram) for gram in index})

    @F.pandas_udf("string")
    def tagged(texts: pd.Series) -> pd.Series:
        def tag_of(text):
            if text is None:
                return None
            found = -1
            for n in lengths:
                for gram in index.keys() & {text[at : at + n] for at in range(len(text) - n + 1)} if n else ("",):
                    for rank in reversed(index[gram]):
                        if rank <= found:
                            break
                        if words[rank] in text:
                            found = rank
                            break
            return tags[found] if found >= 0 else None

        return texts.map(tag_of)

    return tagged


def keyword_tag(description: Column, rules: dict[str, list[str]], default: str = "OTHER") -> Column:
    """Tag of the last rule, in order of declaration, with a keyword in the text.

    Tags are upper-cased, the default is kept as given. Few keywords become
    conditions; from ``KEYWORD_INDEX_LIMIT`` on an index of them is asked.
    """
    low = F.lower(description)
    pairs = [(tag.upper(), word.lower()) for tag, words in rules.items() for word in words]
    if not pairs:
        return F.lit(default)
    if len(pairs) <= CONDITION_CHAIN_LIMIT:
        out = None
        for tag, words in reversed(list(rules.items())):
            if words:
                hit = F.contains(low, F.lit(words[0].lower()))
                for word in words[1:]:
                    hit = hit | F.contains(low, F.lit(word.lower()))
                out = F.when(hit, tag.upper()) if out is None else out.when(hit, tag.upper())
        return out.otherwise(default)
    if len(pairs) > KEYWORD_INDEX_LIMIT:
        return F.coalesce(_indexed_tag(pairs)(low), F.lit(default))
    entries = F.array(
        *[F.struct(F.lit(tag).alias("tag"), F.lit(word).alias("word")) for tag, word in pairs[::-1]]
    )
    hits = F.filter(entries, lambda e: F.contains(low, e["word"]))
    return F.coalesce(F.try_element_at(hits, F.lit(1))["tag"], F.lit(default))
