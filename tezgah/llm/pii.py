"""Personal data replaced by surrogates of the same kind and form.

Entities are found in whole texts, brought to one form, and each different one
gets a surrogate from a keyed hash: digits for digits, letters for letters of
the same script and case, names for names of the same gender. Surrogates are
checked over the whole corpus: no two entities of a kind share one, and none is
itself an entity of the corpus; those that fail are drawn again. A name found
beside a title is known in its whole document: each other mention of it there,
without a title too, gets the same surrogate. What still
fails after ``DRAWS`` draws is numbered, and its surrogate tells the number, in
a longer form where the entity's own has too little room (see ``numbered``). So
what was the same stays the same, and what was different stays different.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tezgah.llm.common import as_row
from tezgah.operators.ranking import global_row_number
from tezgah.sources.shared import stored

#: Draws for one entity before it is numbered.
DRAWS = 16
#: Symbols that stand for one another in secrets; blanks, quotes, brackets and separators are form and stay.
SYMBOLS = "!#$%&*+=?@^|~"
#: Digits of a number that is appended; every BIGINT count of entities fits.
WIDE = 18

# Titles by gender, endings and syllables of invented names.
MALE = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Signor", "господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Signora", "госпожа", "г-жа")
NEUTRAL = ("Dr", "Prof", "Professor", "доктор")
#: Titles that are other words too, or units, where they are in small letters.
NOT_IN_SMALL = {"miss", "ms", "sir", "sr", "sra", "prof"}
#: Words that have a capital where a sentence starts, and are no part of a name beside a title.
NOT_NAMES = {
    "a", "after", "also", "an", "and", "as", "at", "because", "before", "but", "by", "for", "from", "had", "has", "have", "he", "her",
    "his", "how", "i", "if", "in", "is", "it", "its", "later", "my", "no", "not", "of", "on", "or", "our", "said", "she", "since",
    "so", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was", "we", "were", "what", "when", "where",
    "which", "while", "who", "why", "will", "with", "yes", "you", "your",
} | {t.lower() for t in (*MALE, *FEMALE, *NEUTRAL)}
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Drive", "Boulevard", "Blvd", "Square", "Court")
SYLLABLES = {
    "latin": ("ba", "de", "fi", "go", "ka", "le", "mi", "no", "pa", "re", "si", "to", "va", "zu", "lan", "mer"),
    "cyrillic": ("ба", "ве", "го", "да", "зи", "ка", "ле", "ми", "но", "ра", "се", "то", "лан", "мир", "вор", "нел"),
    "greek": ("βα", "γε", "δι", "κα", "λε", "μι", "νο", "πα", "ρε", "σι", "το", "λαν", "μερ", "νικ", "φω", "χα"),
}
ENDINGS = {
    "latin": {"m": ("n", "rd", "s", "ck"), "f": ("a", "ia", "ina", "ette"), "n": ("y", "el", "in", "is")},
    "cyrillic": {"m": ("н", "р", "слав", "ий"), "f": ("а", "ия", "ина", "ла"), "n": ("ен", "ик", "ей", "ко")},
    "greek": {"m": ("ος", "ης", "ας", "ων"), "f": ("α", "η", "ια", "ινα"), "n": ("ι", "ου", "ω", "ις")},
}

_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_ANY_TITLE = (*MALE, *FEMALE, *NEUTRAL)
_WRITTEN = sorted({x for t in _ANY_TITLE for x in (t, t.upper(), t.capitalize(), t.lower()) if x not in NOT_IN_SMALL})
_TITLED = rf"(?<!\w)(?=[{''.join(sorted({t[0] for t in _WRITTEN}))}])({'|'.join(map(re.escape, _WRITTEN))})\.? "
#: Kind, what a text must hold for the pattern to be tried at all, and the pattern; the first to match a place has it.
PATTERNS = [
    ("email", "@", re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")),
    ("secret", "=", re.compile(r"(?i)(?<![\w])(?:password|passwd|pwd|secret|api[_-]?key|token)\s*=\s*[\"']?([^\s\"',;]{4,})")),
    ("secret", ":", re.compile(r"(?i)(?<![\w])(?:password|passwd|pwd|secret|api[_-]?key|token)[\"']?\s*:\s*[\"']?([^\s\"',;]{4,})")),
    ("secret", "earer ", re.compile(r"(?<!\w)[Bb]earer ([A-Za-z0-9._~+/=-]{16,})")),
    ("key", "A", re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)([0-9A-Z]{16})(?![A-Za-z0-9])")),
    ("hex", None, re.compile(r"(?<![0-9A-Za-z])(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])(?:[0-9a-f]{64}|[0-9a-f]{40}|[0-9a-f]{32})(?![0-9A-Za-z])")),
    ("iban", None, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("ip", ".", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?!\w|\.\w)")),
    ("card", None, re.compile(r"(?<![\w.])(?:[2-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7})(?![\w]|\.[0-9])")),
    ("ssn", "-", re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")),
    ("phone", None, re.compile(r"(?<![\w+.])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![\w-]|\.[0-9])")),
    ("birthdate", None, re.compile(r"(?i)(?<!\w)(?:born(?: on)?|date of birth|birth ?date|dob)[:=]? ?([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([./-])[0-9]{1,2}\2[0-9]{4})(?![0-9])")),
    ("address", None, re.compile(rf"(?<![\w.])([0-9]{{1,5}} [A-Z][a-z]+(?: [A-Z][a-z]+){{0,2}}) (?:{'|'.join(STREETS)})(?!\w)")),
    ("name", None, re.compile(rf"{_TITLED}((?:{_NAME})(?: (?!(?:{'|'.join(map(re.escape, _WRITTEN))})(?!\w))(?:{_NAME}))?)")),
]
_TITLES, _WORDS = re.compile(_TITLED), re.compile(_NAME)
_DIGITS = re.compile(r"[0-9]")
MENTIONS = T.ArrayType(T.StructType().add("kind", "string").add("entity", "string").add("start", "integer").add("stop", "integer"))
#: Kinds of which only the digits count.
_BY_DIGITS = {"card", "ssn", "phone"}


def _script(word: str) -> str:
    first = ord(next((c for c in word if c.isalpha()), "a"))
    return "cyrillic" if 0x400 <= first < 0x530 else "greek" if 0x370 <= first < 0x400 else "latin"


_GENDERS = {t.lower(): g for g, titles in (("m", MALE), ("f", FEMALE)) for t in titles}


def _gender(title: str) -> str:
    return _GENDERS.get(title.lower(), "n")


def _may_name(word: str) -> bool:
    return word[0].isupper() and word.lower() not in NOT_NAMES


def _without_s(word: str) -> str:
    """A name without the ending of the possessive."""
    return word[:-2] if word[-2:] in ("'s", "’s") else word


def _elsewhere(text: str, named: list[tuple[str, str, int, int]]) -> list[tuple[str, str, int, int]]:
    """Every word of the text, with a capital first, that is one of the names found in it; of a name's kinds the first counts."""
    kinds: dict[str, str] = {}
    for kind, entity, _, _ in named:
        kinds.setdefault(entity, kind)
    found = []
    for m in _WORDS.finditer(text):
        if m[0][0].isupper():
            for word in {m[0], _without_s(m[0])}:
                if kind := kinds.get(word.lower()):
                    found.append((kind, word.lower(), m.start(), m.start() + len(word)))
                    break
    return found


def mentions_of(text: str | None) -> list[tuple[str, str, int, int]]:
    """Kind, entity in its one form, and place of everything found, in order and without overlaps."""
    if not text:
        return []
    digits, found = bool(_DIGITS.search(text)), []
    for kind, needs, pattern in PATTERNS:
        if needs is not None and needs not in text or needs is None and kind != "name" and not digits or kind == "name" and not _TITLES.search(text):
            continue
        for m in pattern.finditer(text):
            if kind == "name":
                at = m.start(2)
                words = m[2].split(" ")
                for k, whole in enumerate(words):
                    if not _may_name(whole):
                        break
                    word = _without_s(whole)
                    last = k == len(words) - 1 or not _may_name(words[k + 1])
                    part = "last" if last else f"first-{_gender(m[1])}"
                    found.append((f"name-{part}-{_script(word)}", word.lower(), at, at + len(word)))
                    at += len(whole) + 1
                continue
            a, b = m.span(1 if m.lastindex else 0)
            entity = re.sub(r"[^0-9]", "", text[a:b]) if kind in _BY_DIGITS else text[a:b].lower() if kind == "email" else text[a:b].replace(" ", "") if kind == "iban" else text[a:b]
            if kind == "card" and (len(entity) < 13 or _luhn(entity)) or kind == "phone" and not 7 <= len(entity) <= 15:
                continue
            found.append((kind, entity, a, b))
    if named := [m for m in found if m[0].startswith("name-")]:
        found += _elsewhere(text, named)
    taken: list[tuple[str, str, int, int]] = []
    starts: list[int] = []
    order = {k: n for n, (k, _, _) in enumerate(PATTERNS)}
    for m in sorted(found, key=lambda m: (order[m[0].split("-")[0]], m[2])):
        k = bisect.bisect_left(starts, m[3])  # those before k start before m ends
        if not k or taken[k - 1][3] <= m[2]:
            taken.insert(k, m)
            starts.insert(k, m[2])
    return taken


@cache
def _peers(page: int, category: str) -> tuple[str, ...]:
    """Characters of one category among 128 neighbours."""
    return tuple(c for c in map(chr, range(page << 7, (page + 1) << 7)) if unicodedata.category(c) == category)


class _Draw:
    """A stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: object) -> None:
        self.key, self.seed, self.block, self.pool = hashlib.blake2b(key, digest_size=32).digest(), repr(what).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.seed + self.block.to_bytes(4, "little"), key=self.key).digest()
            self.block += 1
        x, self.pool = int.from_bytes(self.pool[:4], "little"), self.pool[4:]
        return x % n

    def alike(self, text: str, hexadecimal: bool = False, symbols: bool = False) -> str:
        """Digits for digits, letters for letters of the same script and case, and if asked symbols for symbols; the rest as it is."""
        out = []
        for c in text:
            if hexadecimal and c in "0123456789abcdef":
                out.append("0123456789abcdef"[self.below(16)])
            elif "0" <= c <= "9":
                out.append(str(self.below(10)))
            elif c.isascii() and c.isalpha():
                out.append(chr((65 if c.isupper() else 97) + self.below(26)))
            elif 0x430 <= ord(c) <= 0x44F or 0x410 <= ord(c) <= 0x42F:
                out.append(chr((0x410 if c.isupper() else 0x430) + self.below(32)))
            elif symbols and c in SYMBOLS:
                out.append(SYMBOLS[self.below(len(SYMBOLS))])
            elif not c.isascii() and unicodedata.category(c)[0] in "LMNPS":
                peers = _peers(ord(c) >> 7, unicodedata.category(c))
                out.append(peers[self.below(len(peers))])
            else:
                out.append(c)
        return "".join(out)


def _luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of an entity in its one form."""
    draw = _Draw(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.partition("@")
        labels = domain.split(".")
        host = _Draw(key, "domain", domain)  # one domain stays one domain
        return f"{draw.alike(local)}@{'.'.join(host.alike(x) for x in labels[:-1])}.{labels[-1]}"
    if kind == "ip":
        low, high = {1: 0, 2: 10, 3: 100}, {1: 10, 2: 100, 3: 255}
        return ".".join(str(low[len(x)] + draw.below(high[len(x)] - low[len(x)])) for x in entity.split("."))
    if kind == "card":
        body = entity[0] + draw.alike(entity[1:])
        return next(x for d in range(10) if _luhn(x := body[:-1] + str(d)) == 0) if _luhn(entity) == 0 else body
    if kind == "phone":
        return entity[: max(0, len(entity) - 10)] + "".join(str(2 + draw.below(8)) if k == 0 else str(draw.below(10)) for k in range(min(10, len(entity))))
    if kind == "iban":
        return entity[:2] + draw.alike(entity[2:])
    if kind == "birthdate":  # a day that is right in either order of day and month
        return re.sub("[0-9]+", lambda m: str(1930 + draw.below(80)) if len(m[0]) == 4 else f"{1 + draw.below(9 if len(m[0]) == 1 else 12):0{len(m[0])}d}", entity)
    if kind.startswith("name-"):
        _, part, *rest = kind.split("-")
        script, gender = rest[-1], rest[0] if part == "first" else "n"
        return "".join(SYLLABLES[script][draw.below(16)] for _ in range(2 + attempt // 4)) + ENDINGS[script][gender][draw.below(4)]
    return draw.alike(entity, hexadecimal=kind == "hex" or bool(re.fullmatch("[0-9a-f]{6,}", entity)), symbols=kind == "secret")


def numbered(kind: str, entity: str, key: bytes, number: int) -> str:
    """A surrogate that no other number of the kind gives, whatever the entity.

    Keys, hex strings, IBANs, cards and SSNs keep their form. Others widen: a
    secret, an address and a birth date by ``WIDE`` digits (a secret is these alone if no character has another to stand for it), a mail's local part to a letter and as many, a
    phone number to 15 digits, an IP to octets of any length, a name to ten
    syllables. Where a form's own numbers end, digits are 40, an IP is IPv6 and
    a name has as many syllables as it takes.
    """
    draw = _Draw(key, kind, entity, "numbered")

    def mixed(size: int) -> int:
        """The number's place in a keyed order of the numbers below ``size``."""
        order = _Draw(key, kind, "order", size)
        factor, shift = (order.below(1 << 31) << 31) + order.below(1 << 31), order.below(1 << 31)
        while math.gcd(factor, size) != 1:
            factor += 1
        return (number * factor + shift) % size

    def digits(n: int) -> str:
        return f"{mixed(10**n):0{n}d}"

    if kind == "email":
        made = surrogate(kind, entity, key)
        return f"u{digits(WIDE)}@{made.partition('@')[2]}"
    if kind == "key":
        return digits(16)
    if kind == "hex":
        return draw.alike(entity[:-16], hexadecimal=True) + digits(16)
    if kind == "ip":
        if number < 1 << 32:
            return ".".join(map(str, mixed(1 << 32).to_bytes(4, "big")))
        return "2001:db8:" + ":".join(f"{number >> k & 0xFFFF:04x}" for k in range(80, -1, -16))
    if kind.startswith("name-"):
        _, part, *rest = kind.split("-")
        script, gender = rest[-1], rest[0] if part == "first" else "n"
        n = max(10, len(f"{number:x}"))
        place = mixed(16**n)
        return "".join(SYLLABLES[script][place >> 4 * k & 15] for k in range(n)) + ENDINGS[script][gender][0]
    if kind in _BY_DIGITS or kind == "iban":
        room = {"iban": 12, "card": len(entity) - 2, "ssn": 9, "phone": 14}[kind]
        if number >= 10 ** min(room, 11 if kind == "card" else room):
            return f"{number:040d}"
        if kind == "card":
            body = entity[0] + digits(room) + "0"
            return body[:-1] + str(-_luhn(body) % 10)
        return {"iban": entity[:2] + draw.alike(entity[2:-12]), "phone": "2"}.get(kind, "") + digits(room)
    like = draw.alike(entity, symbols=True)
    return ("" if like == entity else like) + digits(WIDE)


def rendered(kind: str, mention: str, made: str) -> str:
    """A surrogate in the form that the entity has at this place."""
    if kind in _BY_DIGITS or kind == "iban":
        same = str.isdigit if kind in _BY_DIGITS else str.isalnum
        source = iter(made)
        return "".join([next(source, "0") if same(c) else c for c in mention]) + "".join(source)
    if kind.startswith("name-"):
        return made.upper() if mention.isupper() and len(mention) > 1 else "-".join(x.capitalize() for x in made.split("-"))
    return made.upper() if kind == "email" and mention.isupper() else made


@F.pandas_udf(MENTIONS)
def _mentions(texts: pd.Series) -> pd.Series:
    names = ("kind", "entity", "start", "stop")
    return pd.Series([[dict(zip(names, m, strict=True)) for m in mentions_of(t)] for t in texts], dtype=object)


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """``(kind, entity, surrogate)`` of different ``(kind, entity)``; no two of a kind alike, none an entity itself."""

    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, key, a) for k, e, a in zip(kind, entity, attempt, strict=True)], dtype=object)

    @F.pandas_udf("string")
    def number(kind: pd.Series, entity: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([numbered(k, e, key, int(x)) for k, e, x in zip(kind, entity, n, strict=True)], dtype=object)

    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("taken"))
    tries = stored(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "entity", "attempt")), "surrogates")
    for left in reversed(range(DRAWS)):
        first = tries.groupBy("kind", "surrogate").agg(F.min("entity").alias("first"))
        checked = tries.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        bad = F.col("taken").isNotNull() | (F.col("first") != F.col("entity"))
        judged = checked.select("kind", "entity", "surrogate", (F.col("attempt") + bad.cast("int")).alias("attempt"), bad.alias("bad"))
        if not judged.where("bad").limit(1).count():
            return tries.select("kind", "entity", "surrogate")
        redrawn = F.when(F.col("bad"), draw("kind", "entity", "attempt")).otherwise(F.col("surrogate")) if left else F.col("surrogate")
        tries = stored(judged.select("kind", "entity", "attempt", redrawn.alias("surrogate"), "bad"), "surrogates")
    made = tries.where(~F.col("bad")).select("kind", "entity", "surrogate")
    taken = real.unionByName(made.select("kind", "surrogate", F.lit(True).alias("taken")))
    order = F.sha2(F.concat_ws(" ", F.lit(key.hex()), "kind", "entity"), 256)
    rest = stored(global_row_number(tries.where("bad").select("kind", "entity", order.alias("digest")), ["digest", "kind", "entity"], "n", 0).drop("digest"), "numbered")
    step = rest.count()
    while step and rest.limit(1).count():  # each round has numbers of its own, and what is taken spoils one number at most
        checked = stored(rest.withColumn("surrogate", number("kind", "entity", "n")).join(taken, ["kind", "surrogate"], "left"), "numbered")
        made = made.unionByName(checked.where("taken is null").select("kind", "entity", "surrogate"))
        rest = checked.where("taken").select("kind", "entity", (F.col("n") + step).alias("n"))
    return made


@F.pandas_udf(T.StringType())
def _replaced(texts: pd.Series, mentions: pd.Series, made: pd.Series) -> pd.Series:
    out = []
    for text, places, pairs in zip(texts, mentions, made, strict=True):
        of = {(p["kind"], p["entity"]): p["surrogate"] for p in pairs}
        parts, at = [], 0
        for m in places:
            parts += [text[at : m["start"]], rendered(m["kind"], text[m["start"] : m["stop"]], of[m["kind"], m["entity"]])]
            at = m["stop"]
        out.append("".join([*parts, text[at:]]))
    return pd.Series(out, dtype=object)


def anonymized(docs: DataFrame, key: bytes) -> DataFrame:
    """``(row, text, n_entities)``: each document's columns as a struct, its text with surrogates, and how many it has.

    NULL, empty and clean texts stay as they are. Repeated rows and ids are
    replaced row by row, equal entities alike everywhere; whether a name without
    a title is one depends on its own text alone. Other columns are
    carried; no rows give no rows. The same key gives the same surrogates on the
    same corpus. Texts are searched once, and what was found is stored with them.
    """
    whole = docs.select(as_row(docs.columns), _mentions("text").alias("mentions"), F.monotonically_increasing_id().alias("place"))
    searched = stored(whole, "mentions")
    found = searched.where(F.size("mentions") > 0)
    each = found.select("place", F.explode("mentions").alias("m")).select("place", "m.kind", "m.entity").distinct()
    made = surrogates(stored(each.select("kind", "entity").distinct(), "entities"), key)
    by_place = each.join(made, ["kind", "entity"]).groupBy("place").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("made"))
    replaced = found.join(by_place, "place").select("row", _replaced("row.text", "mentions", "made").alias("text"), F.size("mentions").cast("long").alias("n_entities"))
    clean = searched.where(F.size("mentions") == 0).select("row", F.col("row.text").alias("text"), F.lit(0).cast("long").alias("n_entities"))
    return clean.unionByName(replaced)
