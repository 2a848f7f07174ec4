"""Column functions for names: normalising, classifying, joining, keys and loose search."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def _accent_pairs() -> dict[str, str]:
    """Accented Latin letters and their base letter, by Unicode decomposition."""
    pairs = {}
    for code in range(0xC0, 0x250):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c))
        if len(base) == 1 and base.isascii() and base.isalpha():
            pairs[chr(code).lower()] = base
    return {k: v for k, v in pairs.items() if len(k) == 1 and not k.isascii()}


_ACCENTS = _accent_pairs()


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def normalize_name(name: Column | str) -> Column:
    """Lower case, apostrophes dropped, spaces squeezed and trimmed; null gives ''."""
    bare = F.replace(F.lower(F.coalesce(col(name), F.lit(""))), F.lit("'"), F.lit(""))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def matches_list(name: Column, exact: Sequence[str], keywords: Sequence[str] = ()) -> Column:
    """Whether a normalised name equals a listed one or contains a keyword."""
    normal = normalize_name(name)
    hit = normal.isin(list(exact))
    for word in keywords:
        hit = hit | normal.contains(word)
    return (normal != "") & hit


def classify_names(names: Column | str, exact: Sequence[str], keywords: Sequence[str] = ()) -> Column:
    """The array elements that belong to a class of names, in their order."""
    return F.filter(col(names), lambda n: matches_list(n, exact, keywords))


def join_names(names: Column | str, sep: str = " | ") -> Column:
    """``a | b``, or null for an empty or null array."""
    return F.when(F.size(col(names)) > 0, F.array_join(col(names), sep))


def merge_name_columns(*columns: Column | str) -> Column:
    """Union of several ``a | b`` strings: trimmed, blanks dropped, first occurrence kept."""
    text = F.concat_ws("|", *[col(c) for c in columns])
    parts = F.transform(F.split(text, r"\|"), lambda p: F.trim(p))
    return join_names(F.array_distinct(F.filter(parts, lambda p: p != "")))


def identity_key(name: Column | str, player_class: Column | str | None, realm: Column | str) -> Column:
    """``name:class:realm`` in lower case with 'unknown' for missing parts."""
    unknown = F.lit("unknown")
    parts = [col(name), unknown if player_class is None else F.coalesce(col(player_class), unknown),
             F.coalesce(col(realm), unknown)]
    return F.concat_ws(":", *[F.lower(F.trim(p)) for p in parts])


def realm_slug(realm: Column | str, default: str = "", overrides: dict[str, str] | None = None) -> Column:
    """Realm name to slug: quotes out, spaces and capitals to dashes, then the overrides.

    ``overrides`` maps a slug without dashes to its right spelling.
    """
    text = F.trim(F.coalesce(F.nullif(col(realm), F.lit("")), F.lit(default)))
    dashed = F.translate(F.replace(text, F.lit("'"), F.lit("")), "_ ", "--")
    slug = F.lower(F.regexp_replace(dashed, "([A-Z])", "-$1"))
    slug = F.regexp_replace(slug, "-{2,}", "-")
    plain = F.regexp_replace(slug, "^-+|-+$", "")
    if not overrides:
        return plain
    known = F.create_map(*[F.lit(v) for pair in overrides.items() for v in pair])
    return F.coalesce(F.try_element_at(known, F.replace(slug, F.lit("-"), F.lit(""))), plain)


def fold_text(text: Column | str) -> Column:
    """Lower case, accents folded, only letters and digits kept."""
    return F.regexp_replace(F.translate(F.lower(F.coalesce(col(text), F.lit(""))), "".join(_ACCENTS), "".join(_ACCENTS.values())),
                            "[^a-z0-9]", "")


def _subsequence(letters: str) -> str:
    """Pattern that finds the letters in order; each step stops at the first hit, so it is linear."""
    return "^" + "".join(f"[^{c}]*{c}" for c in letters)


def loose_match(text: Column | str, query: str) -> Column:
    """Contains the folded query, or (from 5 letters) shares 3 letters and holds it as a subsequence."""
    plain = unicodedata.normalize("NFKD", query).lower()
    folded_query = "".join(c for c in plain if c.isascii() and c.isalnum())
    if not folded_query:
        return F.lit(True)
    folded = fold_text(text)
    hit = folded.contains(folded_query)
    if len(folded_query) >= 5:
        hit = hit | (folded.startswith(folded_query[:3]) & folded.rlike(_subsequence(folded_query)))
    return hit


def weapon_names(gear: Column, imbues: dict[int, str]) -> Column:
    """Distinct temporary weapon enchant names: written names, then names known only by id."""
    known = F.create_map(*[F.lit(v) for pair in imbues.items() for v in pair])
    none = F.array().cast("array<string>")
    written = F.coalesce(F.transform(gear, lambda g: F.trim(g["temporaryEnchantName"])), none)
    by_id = F.coalesce(F.transform(gear, lambda g: F.try_element_at(known, g["temporaryEnchant"].cast("int"))), none)
    return F.array_distinct(F.filter(F.concat(written, by_id), lambda n: n.isNotNull() & (n != "")))
