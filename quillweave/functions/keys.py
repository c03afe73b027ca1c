"""Lookup keys: spellings of a name that mean the same collapse to one key."""

from __future__ import annotations

import functools
import re
import sys
import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Greek letters that are spelled out.
GREEK = {
    "α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon",
    "κ": "kappa", "λ": "lambda", "μ": "mu", "τ": "tau", "ω": "omega",
}
_SPELLED = str.maketrans(GREEK)
#: Words of fewer letters are not taken for plurals.
LEAST_PLURAL = 4


def spelled(text: str) -> str:
    """Lower case, Greek spelled out, accents and possessives gone, words sorted."""
    bare = (c for c in unicodedata.normalize("NFKD", text.lower().translate(_SPELLED)) if not unicodedata.combining(c))
    return " ".join(sorted(re.findall(r"[0-9a-z]+", re.sub(r"['’`]s\b", "", "".join(bare)))))


def _normal(c: str) -> str:
    """What `spelled` makes of one character before it looks for words: small ASCII letters and digits, an apostrophe, `_` for any
    other word character, a blank for the rest; runs of those two are one."""
    bare = (d for d in unicodedata.normalize("NFKD", c.lower().translate(_SPELLED)) if not unicodedata.combining(d))
    kept = "".join(d if d in _PLAIN else "'" if d in "'’`" else "_" if d.isalnum() or d == "_" else " " for d in bare)
    return re.sub(r"([ _])\1+", r"\1", kept)


#: Leaves out ASCII before a long class is searched.
_BEYOND = r"(?![\x00-\x7F])"
_PLAIN = frozenset("0123456789abcdefghijklmnopqrstuvwxyz")


@functools.cache
def _tables() -> tuple[str, str, dict[str, str], str]:
    """Made once from the Unicode data: characters that become one, those they become (characters beyond its length become none), those
    that become several, and a class of the other word characters, as ranges."""
    single, target, none, several, ranges = [], [], [], {}, []
    for n in range(sys.maxunicode + 1):
        if n < 0x80 and not 65 <= n <= 90 and n != 0x60 or 0xD800 <= n < 0xE000:
            continue
        c = chr(n)
        itself = n > 0x7F and c != "’" and c not in GREEK and not unicodedata.decomposition(c) and c.lower() == c
        to = _normal(c) if not itself else "" if unicodedata.combining(c) else "_" if c.isalnum() else " "
        if to == "_":
            if ranges and ranges[-1][1] == n - 1:
                ranges[-1][1] = n
            else:
                ranges.append([n, n])
        elif not to:
            none.append(c)
        elif len(to) > 1:
            several[c] = to
        elif to != " ":
            single.append(c)
            target.append(to)
    word = "".join(f"\\x{{{i:X}}}" if i == j else f"\\x{{{i:X}}}-\\x{{{j:X}}}" for i, j in ranges)
    return "".join(single + none), "".join(target), several, f"{_BEYOND}[{word}]"


def _class(characters: Iterable[str]) -> str:
    return _BEYOND + "[" + "".join(f"\\x{{{ord(c):X}}}" for c in characters) + "]"


def _ascii(text: Column) -> Column:
    """The text in the letters that keys are made of, all in the JVM. Greek letters are replaced one after another; other characters that
    become several are looked up only in texts that hold one."""
    single, target, several, word = _tables()
    out = F.translate(text, single, target)
    greek = [c for letter in GREEK for c in (letter, letter.upper()) if c in several]
    for c in greek:
        out = F.replace(out, F.lit(c), F.lit(several[c]))
    rest = {c: t for c, t in several.items() if c not in greek}
    known = F.str_to_map(F.lit("\x02".join(f"{c}\x01{t}" for c, t in rest.items())), F.lit("\x02"), F.lit("\x01"))  # one literal, read once
    spelled_out = F.array_join(F.transform(F.split(out, ""), lambda c: F.when(c < "\x80", c).otherwise(F.coalesce(F.try_element_at(known, c), c))), "")
    out = F.when(out.rlike(_class(rest)), spelled_out).otherwise(out)
    return F.regexp_replace(F.regexp_replace(out, word, "_"), r"[^\x00-\x7F]", " ")


def normalize_key(text: Column) -> Column:
    """The key of a name: `spelled` of it. It is worked out in the JVM, for ASCII names without a look at the Unicode tables."""
    plain = F.coalesce(text, F.lit("")).rlike(r"^\p{ASCII}*$")
    low = F.regexp_replace(F.when(plain, F.lower(text)).otherwise(_ascii(text)), r"['`]s\b", "")
    key = F.array_join(F.array_sort(F.filter(F.split(low, "[^0-9a-z]+"), lambda w: w != "")), " ")
    return F.coalesce(key, F.lit(""))


def singular(word: Column) -> Column:
    """-ies to -y, -s dropped unless -ss, for words that are long enough."""
    cut = lambda n: F.substring(word, F.lit(1), F.length(word) - n)
    return F.when(F.length(word) < LEAST_PLURAL, word).when(word.endswith("ies"), F.concat(cut(3), F.lit("y"))).when(word.endswith("s") & ~word.endswith("ss"), cut(1)).otherwise(word)


def keys_of(key: Column) -> Column:
    """array<string>: the key, and that of its singular words if it is another."""
    one = F.array_join(F.array_sort(F.transform(F.split(key, " "), singular)), " ")
    return F.array_distinct(F.array(key, one))


def lookup_keys(text: Column) -> Column:
    return keys_of(normalize_key(text))


def candidate_keys(surface: Column, long_form: Column) -> Column:
    """Keys to try in order: of the long form that the surface abbreviates (or null), of the surface, of the surface
    without what stands in parentheses. Empty ones and repetitions are left out."""
    bare = F.regexp_replace(surface, r"(?U)[\s\x1C-\x1F]*\([^()]*\)", "")
    none = F.array().cast("array<string>")
    parts = (F.when(F.coalesce(long_form, F.lit("")) != "", lookup_keys(long_form)).otherwise(none), lookup_keys(surface), F.when(bare != surface, lookup_keys(bare)).otherwise(none))
    return F.array_distinct(F.filter(F.concat(*parts), lambda k: k != ""))
