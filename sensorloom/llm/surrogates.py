"""Surrogates for personal data: keyed, consistent, of the same type, script and format.

Entities are found by patterns and checks: mail addresses, phone numbers, IPv4 addresses, payment
cards, bank accounts, keys and passwords, and names after a title, which tells their gender, with
all further mentions of these names in the same text.
An entity's surrogate is drawn from a keyed hash of its type and canonical form, so it is the
same wherever the entity occurs (coreference), also in another notation.  Surrogates are then
checked over the whole corpus: none may equal an entity that occurs, and no two entities may
share one (distinctness).  The entity that loses a collision draws again until nothing collides.
Rendering keeps the notation: punctuation, grouping, letter case.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import located, set_aside, stored
from sensorloom.operators.skew import join_skewed

# Titles by gender, and alphabets by script.
TITLES = {
    "f": "Mrs Ms Miss Madam Frau Mme Madame Mlle Sra Señora Srta г-жа госпожа κυρία",
    "m": "Mr Sir Herr M Monsieur Sr Señor г-н господин κύριος",
    "n": "Dr Prof",
}
# Words with a capital that follow a title without being a name.
NO_NAMES = """President Chairman Chairwoman Chair Speaker Minister Secretary Chancellor Ambassador Mayor Governor Senator Justice Judge
General Director Professor Doctor Präsident Präsidentin Ministerin Kanzler Kanzlerin Bürgermeister Bürgermeisterin Professorin
Doktor Président Présidente Ministre Maire Presidente Presidenta Ministro Ministra Alcalde Who What Where When Why How The This That A An
And Or But Of In On At To For He She It They We You I Der Die Das Und Oder Le La Les Et Ou El Los Las Y""".split()
ALPHABETS = {
    "latin": ("aeiou", "bcdfghjklmnprstvwz"),
    "cyrillic": ("аеиоу", "бвгдзклмнпрстфх"),
    "greek": ("αειοω", "βγδζκλμνπρσφχ"),
}
FIRST_ENDS = {"latin": {"f": "a", "m": "o", "n": "e"}, "cyrillic": {"f": "а", "m": "о", "n": "е"}, "greek": {"f": "α", "m": "ο", "n": "ε"}}

_TITLE = "|".join(sorted({t for v in TITLES.values() for t in v.split()}, key=len, reverse=True))
_GENDER = {t: g for g, v in TITLES.items() for t in v.split()}
_SECRET = "token|secret|api_?key|password|passwd|pwd"
_NAME = rf"(?!(?:{'|'.join(NO_NAMES)})(?![\w'’-]))[^\W\d_a-zа-яα-ω](?:\w+|['’]\w+)(?:[-'’]\w+)*"
_NUMBER = r"""(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
|(?P<phone>(?<![\w.:/+-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}(?:[ .-]\d{2,4}){1,3}(?![\w]))
|(?P<phone2>(?<![\w.:/+-])\+\d(?:[ .-]?\d){7,14}(?!\w))"""
PATTERNS = re.compile(
    rf"""(?<![\w.%+-])[._%+-]*+(?P<mail>[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{{2,}})
|(?P<aws>\bAKIA[A-Z0-9]{{16}}\b)
|(?P<secret>(?:\b(?ai:{_SECRET}))["']?\s?[=:]\s?["']?(?P<value>[A-Za-z0-9_\-/+]{{8,}}))
|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d))
|(?P<iban>\b[A-Z]{{2}}\d{{2}}(?:\s?[A-Z0-9]{{4}}){{2,7}}(?:\s?[A-Z0-9]{{1,4}})?\b)
|(?P<card>(?<![\w.-])\d(?:[ -]?\d){{12,18}}(?![\w-]))
|{_NUMBER}
|(?P<person>\b(?P<title>{_TITLE})\.?\s(?P<name>{_NAME}(?:\s{_NAME}){{0,2}}))""",
    re.VERBOSE,
)
NUMBERS = re.compile(_NUMBER, re.VERBOSE)
# What a text with any entity has, for a cheap test in the scan, as a pattern of Java: every match
# of PATTERNS has one.  Digits may be unknown to Java's older Unicode; borders are those of ASCII.
HINT = rf"[\p{{Nd}}\p{{Cn}}@]|AKIA|(?<![a-zA-Z0-9_])(?:{_TITLE}|(?i:{_SECRET}))(?![a-zA-Z0-9_])"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    """The digits of any script as those of ASCII."""
    return "".join(str(int(c)) for c in text if c.isdecimal())


def _iban_rest(code: str) -> int:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97


_MONTH = re.compile(r"(?<!\d)(?:19|20)\d\d[-. ][01]\d(?!\d)")


def is_phone(number: str) -> bool:
    """Whether 7 to 15 grouped digits are written like a phone number.

    They begin with a plus sign, have an area code in brackets, begin with 0, or are grouped by
    3, 3 and 4.  Dates and rows of numbers aren't phones.
    """
    digits, groups = _digits(number), [len(g) for g in re.findall(r"\d+", number)]
    if not 7 <= len(digits) <= 15:
        return False
    if number[0] == "+" or "(" in number:
        return True
    dated = tuple(groups[:3]) in ((4, 2, 2), (2, 2, 4)) or groups == [2, 2, 2] or _MONTH.search(number)
    return not dated and (digits[0] == "0" or groups == [3, 3, 4])


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """Entities of a text in order: start, end, type, canonical form."""
    text, out, at = text or "", [], 0
    while m := PATTERNS.search(text, at):
        if m.group("card") and not luhn(_digits(m.group())):
            # Not a card; it may still be a number in the notation of a phone.
            at, m = m.end(), NUMBERS.match(text, m.start())
            if m is None:
                continue
        groups = m.groupdict()
        kind = next(k for k in ("mail", "aws", "secret", "ip", "iban", "card", "ssn", "phone", "phone2", "person") if groups.get(k))
        (a, b), at = m.span(kind), m.end()
        if kind == "mail":
            local, domain = m.group("mail").lower().rsplit("@", 1)
            out.append((a, a + len(local), "mail", f"{local}@{domain}"))
            name, top = domain.rsplit(".", 1)
            out.append((a + len(local) + 1, a + len(local) + 1 + len(name), "domain", domain))
        elif kind == "secret":
            out.append((*m.span("value"), "secret", m.group("value")))
        elif kind == "iban":
            code = re.sub(r"\s", "", m.group())
            if 15 <= len(code) <= 34 and _iban_rest(code) == 1:
                out.append((a, b, "iban", code))
        elif kind == "card":
            out.append((a, b, "card", _digits(m.group())))
        elif kind in ("ssn", "phone", "phone2"):
            if kind == "ssn" or is_phone(m.group()):
                out.append((a, b, "ssn" if kind == "ssn" else "phone", _digits(m.group())))
            else:  # another number may begin in it
                at = a + re.match(r"\D*\d+", m.group()).end()
        elif kind == "person":
            start, words = m.start("name"), list(re.finditer(r"\S+", m.group("name")))
            gender = _GENDER[m.group("title")]
            for i, w in enumerate(words):
                given, name = i < len(words) - 1, re.sub(r"['’]s$", "", w.group())
                out.append((start + w.start(), start + w.start() + len(name), f"given_{gender}" if given else "family", name.casefold()))
        else:
            out.append((a, b, kind, m.group()))
    return sorted(out + _bare(text, out)) if out else out


def _bare(text: str, found: list[tuple[int, int, str, str]]) -> list[tuple[int, int, str, str]]:
    """Further mentions, without a title, of the names found in a text: the words written with a capital, outside other entities."""
    names, forms = {}, set()
    for a, b, kind, canonical in found:
        if kind == "family" or kind.startswith("given_"):
            names.setdefault(canonical, kind)
            forms |= {canonical, text[a:b]}
    if not names:
        return []
    taken, out, at = sorted((a, b) for a, b, *_ in found), [], 0
    for m in re.finditer(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(forms, key=len, reverse=True)))})(?!\w)", text, re.IGNORECASE):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        free = at == len(taken) or m.end() <= taken[at][0]
        canonical = m.group().casefold()
        if free and not m.group()[0].islower() and canonical in names:
            out.append((*m.span(), names[canonical], canonical))
    return out


class Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *parts: str):
        self.seed, self.n, self.pool = hashlib.blake2b("\x1f".join(parts).encode(), key=key[:64]).digest(), 0, 0

    def below(self, n: int) -> int:
        if self.pool < 1 << 32:
            self.n += 1
            self.pool = int.from_bytes(hashlib.blake2b(self.seed + self.n.to_bytes(4, "big")).digest(), "big")
        self.pool, out = divmod(self.pool, n)
        return out


def script_of(word: str) -> str:
    for c in word:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ":
            return "greek"
    return "latin"


def _like(draw: Draw, text: str) -> str:
    """Digits for digits and letters for letters of their script and case; the rest stays."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            vowels, others = ALPHABETS[script_of(c)]
            pick = vowels if c.lower() in vowels else others
            x = pick[draw.below(len(pick))]
            out.append(x.upper() if c.isupper() else x)
        else:
            out.append(c)
    return "".join(out)


def _hex_or_like(draw: Draw, text: str) -> str:
    if re.fullmatch(r"[0-9a-f]+", text):
        return "".join("0123456789abcdef"[draw.below(16)] for _ in text)
    return "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[draw.below(36)] if c.isupper() or c.isdigit() else _like(draw, c) for c in text)


LONGER = 16


def surrogate(key: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The canonical form of an entity's surrogate.

    Later attempts are longer, so that a format with few values never runs out: names and mail
    addresses from the fifth on, numbers and keys from the ``LONGER``-th on.
    """
    draw = Draw(key, kind, canonical, str(attempt))
    more, longer = max(0, attempt - 4), max(0, attempt - LONGER)
    if kind == "mail":
        return _like(draw, canonical.rsplit("@", 1)[0]) + _like(draw, "a" * more)
    if kind == "domain":
        return _like(draw, canonical.rsplit(".", 1)[0]) + _like(draw, "a" * more)
    if kind == "ip":
        return ".".join(str(1 + draw.below(254)) for _ in range(4 + longer))
    if kind == "card":
        body = canonical[0] + "".join(str(draw.below(10)) for _ in canonical[1:-1] + "0" * longer)
        last = [d for d in "0123456789" if luhn(body + d) == luhn(canonical)]
        return body + last[draw.below(len(last))]
    if kind == "iban":
        tail = _like(draw, canonical[4:] + "0" * longer).upper()
        return canonical[:2] + f"{98 - _iban_rest(canonical[:2] + '00' + tail):02d}" + tail
    if kind in ("phone", "ssn"):
        # Leading digits (the country, or none) stay; no group starts with 0 where it didn't.
        stay = max(0, len(canonical) - 10)
        return canonical[:stay] + "".join(str(1 + draw.below(9)) if c != "0" and i == 0 else str(draw.below(10)) for i, c in enumerate(canonical[stay:] + "0" * longer))
    if kind == "aws":
        return "AKIA" + _hex_or_like(draw, "A" * (len(canonical) - 4 + longer))
    if kind == "secret":
        return _hex_or_like(draw, canonical + "0" * longer)
    script = script_of(canonical)
    vowels, others = ALPHABETS[script]
    sounds = "".join(others[draw.below(len(others))] + vowels[draw.below(len(vowels))] for _ in range(max(1, len(canonical) // 2) + more))
    ends = FIRST_ENDS[script].get(kind.rsplit("_", 1)[-1], others[draw.below(len(others))]) if kind.startswith("given_") else others[draw.below(len(others))]
    return (sounds[:-1] if kind.startswith("given_") else sounds) + ends


def render(surface: str, kind: str, found: str) -> str:
    """A surrogate in the notation of what it replaces."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(found)
        shown = "".join(chr(ord(c) - int(c) + int(next(digits))) if c.isdecimal() else c for c in surface)
        return shown + "".join(digits)  # those of a longer surrogate
    if kind == "iban":
        letters = iter(found)
        return "".join(c if c.isspace() else next(letters) for c in surface) + "".join(letters)
    if kind in ("mail", "domain"):
        return found.upper() if surface.isupper() else found
    if kind.startswith(("given", "family")):
        return found.upper() if surface.isupper() and len(surface) > 1 else found.capitalize()
    return found


def assign(entities: DataFrame, key: bytes) -> DataFrame:
    """A surrogate for every row ``type, canonical``: none that occurs in the corpus, no two alike in a type."""
    entities = stored(entities.distinct(), "surrogate-entities")

    @F.pandas_udf("string")
    def draw(kinds: pd.Series, canonicals: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, k, c, int(n)) for k, c, n in zip(kinds, canonicals, attempts)], dtype=object)

    # What a surrogate must not be: the part of an entity that gets replaced.
    at = F.when(F.col("type") == "mail", F.regexp_extract("canonical", r"^(.*)@", 1)).when(F.col("type") == "domain", F.regexp_extract("canonical", r"^(.*)\.", 1))
    taken = entities.select("type", F.coalesce(at, F.col("canonical")).alias("surrogate")).distinct().withColumn("real", F.lit(True))
    todo, done, attempt = entities, None, 0
    while True:
        drawn = todo.withColumn("surrogate", draw("type", "canonical", F.lit(attempt)))
        if done is not None:
            taken_now = taken.select("type", "surrogate").union(done.select("type", "surrogate")).distinct().withColumn("real", F.lit(True))
        else:
            taken_now = taken
        drawn = drawn.join(taken_now, ["type", "surrogate"], "left")
        # Of entities that drew one surrogate, the first keeps it.
        first = drawn.groupBy("type", "surrogate").agg(F.min("canonical").alias("first"))
        drawn = stored(drawn.join(first, ["type", "surrogate"]).withColumn("ok", F.col("real").isNull() & (F.col("canonical") == F.col("first"))), "surrogate-drawn")
        good = drawn.filter("ok").select("type", "canonical", "surrogate")
        done = good if done is None else done.unionByName(good)
        todo = drawn.filter("not ok").select("type", "canonical")
        attempt += 1
        if todo.isEmpty():
            return done


HOT_MENTIONS = 1_000_000
MENTIONS = "array<struct<start:int,stop:int,type:string,canonical:string>>"


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_entities``, how many mentions were replaced.

    Texts without an entity stay as they are, null ones too; repeated rows are replaced alike.
    Texts without a digit, an at sign, AKIA, a title or the name of a secret skip the search.
    A column ``n_entities`` of ``docs`` is replaced; others stay, whatever their names.
    """
    mine, back = set_aside(docs, text=text_col)

    @F.pandas_udf(MENTIONS)
    def mentions(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "stop": b, "type": k, "canonical": c} for a, b, k, c in find(t)] for t in texts], dtype=object)

    @F.pandas_udf("string")
    def rewrite(texts: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for text, rows in zip(texts, found):
            parts, at = [], 0
            for r in sorted(rows, key=lambda r: r["start"]):
                parts += [text[at : r["start"]], render(text[r["start"] : r["stop"]], r["type"], r["surrogate"])]
                at = r["stop"]
            out.append("".join(parts) + text[at:])
        return pd.Series(out, dtype=object)

    places, text = located(mine), F.col("text")
    hinted = text.isNotNull() & text.rlike(HINT)
    seen = places.filter(hinted).select("_file", "_row", F.explode(mentions(text)).alias("m")).select("_file", "_row", "m.*")
    seen = stored(seen, "surrogate-mentions")
    chosen = assign(seen.select("type", "canonical"), key)
    # A domain or name may be that of a third of all mentions.
    replaced = join_skewed(seen, chosen, ["type", "canonical"], ["_file", "_row"], "inner", HOT_MENTIONS)
    per_row = replaced.groupBy("_file", "_row").agg(F.collect_list(F.struct("start", "stop", "type", "surrogate")).alias("found"))
    some = places.filter(hinted).join(per_row, ["_file", "_row"], "left")
    none = F.col("found").isNull()
    changed = F.when(none, text).otherwise(rewrite(F.coalesce(text, F.lit("")), F.coalesce("found", F.array().cast("array<struct<start:int,stop:int,type:string,surrogate:string>>"))))
    some = some.withColumn("text", changed).withColumn("n_entities", F.when(none, 0).otherwise(F.coalesce(F.size("found"), F.lit(0))))
    rest = places.filter(~F.coalesce(hinted, F.lit(False))).withColumn("n_entities", F.lit(0))
    return back(some, "n_entities").unionByName(back(rest, "n_entities"))
