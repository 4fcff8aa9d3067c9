"""Names and texts as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that say what kind of company a name belongs to.
LEGAL_WORDS = ("inc", "ltd", "limited", "llc", "plc", "corp", "corporation", "company", "sa", "ag", "nv", "bv", "gmbh", "bank", "the")
#: Characters of the basic plane that Unicode's compatibility decomposition turns into ASCII: one for one, and the others.
_PLAIN = {c: unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in map(chr, range(0x80, 0x10000)) if not 0xD800 <= ord(c) < 0xE000}
SINGLE = {c: p for c, p in _PLAIN.items() if len(p) == 1}
LONGER = {c: p for c, p in _PLAIN.items() if len(p) > 1}


def terms(text: Column) -> Column:
    """Lower-case runs of letters and ASCII digits."""
    return F.expr(f"regexp_extract_all(lower({_sql(text)}), r'[\\p{{L}}0-9]+', 0)")


def _sql(column: Column | str) -> str:
    if isinstance(column, str):
        return f"`{column}`"
    raise TypeError("a column's name is asked for")


def capitalised(text: Column) -> Column:
    """Runs of words with a capital ASCII letter followed by small ones, in order, repeats included."""
    return F.regexp_extract_all(text, F.lit("([A-Z][a-z]+(?: [A-Z][a-z]+)*)"), F.lit(1))


def ascii_of(text: Column) -> Column:
    """What ASCII a text decomposes into (NFKD): letters without their accents, ligatures as letters; all other characters go."""
    longer = F.create_map(*[F.lit(x) for pair in LONGER.items() for x in pair])
    spelt = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(longer[c], c)), "")
    text = F.when(text.rlike(f"[{''.join(LONGER)}]"), spelt).otherwise(text)
    text = F.translate(text, "".join(SINGLE), "".join(SINGLE.values()))
    return F.regexp_replace(text, r"[^\x00-\x7F]", "")


def normalise_name(name: Column) -> Column:
    """Lower case without accents, legal words and punctuation; single spaces. Characters that don't decompose into ASCII go."""
    plain = F.regexp_replace(F.lower(F.when(name.rlike(r"[^\x00-\x7F]"), ascii_of(name)).otherwise(name)), "[^a-z0-9]+", " ")
    plain = F.regexp_replace(plain, rf"\b({'|'.join(LEGAL_WORDS)})\b", " ")
    return F.trim(F.regexp_replace(plain, " +", " "))


def blocking_key(node_type: Column, country: Column, name: Column, jurisdiction: Column | None = None) -> Column:
    """type|COUNTRY|first four letters of the name's first word; for a missing country the jurisdiction, if there is one, else nothing."""
    places = [F.nullif(country, F.lit("")), *([jurisdiction] if jurisdiction is not None else []), F.lit("")]
    return F.concat_ws("|", node_type, F.upper(F.coalesce(*places)), F.substring(F.substring_index(normalise_name(name), " ", 1), 1, 4))


def trigrams(text: Column) -> Column:
    """The set of three-letter windows over lower-case words padded with two spaces before and one after."""
    words = F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, cut)))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Common trigrams among all of both; of their arrays."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either > 0, both / either).otherwise(0.0)
