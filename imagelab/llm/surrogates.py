"""Personal data replaced by keyed surrogates of the same type, script and format.

Detected entities are e-mail addresses, phone, card, account and social security numbers, IP
addresses, secrets, and names after a title or beginning with a common given name. A surrogate is
the image of the entity under a keyed permutation of all values of the same shape: digits stay
digits, vowels and consonants of a script stay what they are, upper case stays upper case, octets
stay octets, a valid check digit stays valid, and a listed given name becomes another one of its list,
all others being permuted without the listed ones. The permutation has no fixed points. So one
entity has one surrogate in the whole corpus, nothing is looked up and no text moves. Values of more
than `LONGEST` characters are permuted in blocks, each under a permutation that depends on all before.

A given name that is not listed, after a title that states a gender, becomes a listed one of that
gender and script. Once a person is found in a document, the full name is replaced wherever it
stands there, in any case, and so are the words of the name where they begin with a capital letter, all by
the same words; a title states the gender for all of them.

That two originals share no surrogate is checked over all entities, by keyed fingerprints. It can
happen where notation decides the shape (+1 017... and +10 17... read the same), and for given names
that go to one list. All but one of those that share a surrogate are re-keyed, and only the rows
that hold them are made again, until nothing clashes; a given name that clashes `LISTED_TURNS` times
becomes a word of its own shape. The list of re-keyed entities is a table, never the driver's.

Defined results: null texts stay null; texts without entities stay as they are; repeated rows and
equal entities, in whatever notation, get equal surrogates; an empty table gives no rows.
"""

import hashlib
import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imagelab.llm.common import col
from imagelab.session import materialise, ship_package

ROUNDS = 8
REKEYS = 100  # rounds of re-keying what clashes; more are only used up when a shape has no free values
LISTED_TURNS = 4  # of which so many choose from a list of given names
LONGEST = 64  # letters and digits that are permuted as one value

# Letters of the scripts by class; a letter only ever becomes one of its class.
ALPHABETS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåæèéêëìíîïòóôõöøùúûüýÿœ", "çñßðþłšžćčń",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "άέήίόύώ",
)
# Common given names by script and gender.
GIVEN_NAMES = (
    "james john robert michael william david thomas daniel paul peter hans karl pierre louis jean carlos juan miguel jose antonio "
    "george henry edward charles richard joseph stefan andreas martin klaus jürgen wolfgang françois jacques henri luis pedro javier diego pablo",
    "mary anna emma sarah laura julia maria elena sophie marie claire lucia carmen isabel greta helga ingrid alice susan linda "
    "elizabeth margaret jennifer patricia emily charlotte ursula monika sabine petra hannah camille juliette chloé pilar rosa teresa ana beatriz inés",
    "иван пётр алексей дмитрий сергей николай михаил андрей владимир александр",
    "анна мария елена ольга наталья ирина татьяна светлана екатерина людмила",
)
# Titles by the gender that they state.
TITLES = {"m": "Mr Herr Monsieur Señor Sr Don Г-н", "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Doña Г-жа", "": "Dr Prof"}
_NAME_LISTS = [names.split() for names in GIVEN_NAMES]
_PLACE = {c: (kind, at) for kind, letters in enumerate(ALPHABETS) for at, c in enumerate(letters)}
_LIST_OF = {name: names for names in _NAME_LISTS for name in names}

_WORD = r"[^\W\d_](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
_CAPITAL = rf"(?-i:(?=[A-ZÀ-ÞА-ЯΑ-Ω]){_WORD})"
_GENDER = {title: gender for gender, titles in TITLES.items() for title in titles.split()}
_TITLE = rf"(?:{'|'.join(sorted(_GENDER, key=len, reverse=True))})\.?"
_LISTS = {(gender, script): at for at, (script, gender) in enumerate([("latin", "m"), ("latin", "f"), ("cyrillic", "m"), ("cyrillic", "f")])}
_ANY_WORD = re.compile(_WORD + r"|[^\W\d_]")
_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAMES = "|".join(sorted({n.capitalize() for n in _LIST_OF}))
KINDS = {
    "secret": r"""\b(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)\b\s*[:=]\s*["']?(?P<secret_value>[A-Za-z0-9+/_=-]{8,})"""
    r"|\b(?P<secret_bare>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})\b",
    "email": r"(?<![\w.+-])[\w.+-]+@[^\W_]+(?:-+[^\W_]+)*(?:\.[^\W_]+(?:-+[^\W_]+)*)+",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)",
    "ip6": rf"(?<![\w:])(?:{_HEX}(?::{_HEX}){{7}}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\w:])",
    "phone": r"(?<![\w+])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)"
    r"|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "person": rf"\b(?:(?P<title>{_TITLE})\s+(?P<titled>{_CAPITAL}(?: {_CAPITAL}){{0,2}})|(?P<named>(?:{_NAMES}) {_CAPITAL}))\b",
}
_NUMBERS = re.compile("|".join(f"(?P<{kind}>{KINDS[kind]})" for kind in KINDS if kind != "person"))
_PERSONS = re.compile(f"(?P<person>{KINDS['person']})")
# In every match of _NUMBERS: bare secrets have their prefix, other secrets a key word, e-mail addresses an @, addresses of
# hexadecimal groups two colons around one or in a row, the rest a digit.
_HINT = re.compile(rf"\d|@|::|:{_HEX}:|AKIA|gh[pousr]_|sk-|(?i:token|secret|passw|key)")


@dataclass(frozen=True)
class Person:
    """A name in lower case, and the gender that a title states."""

    words: tuple[str, ...]
    gender: str = ""

    @property
    def canonical(self) -> str:
        """What tells persons apart; the gender counts where it decides about the surrogate."""
        name = " ".join(self.words)
        return f"{self.gender}~{name}" if self.gender and len(self.words) > 1 and self.words[0] not in _LIST_OF else name


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    person: Person | None = None


def detect(text: str) -> list[Entity]:
    """Entities in order of their place, none inside another."""
    found = []
    if _HINT.search(text):
        found = [_entity(m) for m in _NUMBERS.finditer(text)]
    names = [_entity(m) for m in _PERSONS.finditer(text)]
    if found and names:
        names = _apart(names, found)
    if names:
        names = _with_mentions(text, names, found)
    return sorted(found + names, key=lambda e: e.start)


def _apart(some: list[Entity], others: list[Entity]) -> list[Entity]:
    """Those that overlap none of the others; both in order of their place."""
    starts = [e.start for e in others]
    return [e for e in some if (at := bisect_right(starts, e.end - 1)) == 0 or others[at - 1].end <= e.start]


def _entity(match: re.Match) -> Entity:
    for part in ("secret_value", "secret_bare"):
        if part in match.re.groupindex and match[part] is not None:
            return Entity(*match.span(part), "secret")
    for part in ("titled", "named"):
        if part in match.re.groupindex and match[part] is not None:
            title = (match["title"] or "").rstrip(".")
            gender = next((g for t, g in _GENDER.items() if t.lower() == title.lower()), "")
            return Entity(*match.span(part), "person", Person(tuple(_folded_name(match[part]).split(" ")), gender))
    return Entity(*match.span(), match.lastgroup)


def _with_mentions(text: str, names: list[Entity], others: list[Entity]) -> list[Entity]:
    """The names, and all later and earlier mentions of the same persons, as the persons they are."""
    genders: dict[tuple[str, ...], str] = {}
    for e in names:
        genders[e.person.words] = genders.get(e.person.words) or e.person.gender
    of_given = {words[0]: gender for words, gender in genders.items() if gender and len(words) > 1}
    persons = {}
    for words, gender in genders.items():
        persons[words] = Person(words, gender or (of_given.get(words[0], "") if len(words) > 1 else ""))
    whole = [Entity(e.start, e.end, "person", persons[e.person.words]) for e in names]
    by_first: dict[str, list[Person]] = {}
    by_word: dict[str, Person] = {}
    for person in sorted(persons.values(), key=lambda p: -len(p.words)):  # longer names first
        if len(person.words) > 1:
            by_first.setdefault(person.words[0], []).append(person)
        for word in person.words:
            by_word.setdefault(word, person)
    words = [(m.start(), m.end(), _folded_name(m[0])) for m in _ANY_WORD.finditer(text)]
    found, at = [], 0
    while at < len(words):
        start, end, word = words[at]
        used, person = 1, None
        for full in by_first.get(word, ()):
            span = words[at : at + len(full.words)]
            if tuple(w for *_, w in span) == full.words and all(text[a[1] : b[0]].isspace() for a, b in zip(span, span[1:])):
                used, end, person = len(full.words), span[-1][1], full
                break
        if person is None and word in by_word and text[start].isupper():
            person = by_word[word]
        if person is not None:
            found.append(Entity(start, end, "person", person))
        at += used
    taken = sorted(whole + others, key=lambda e: e.start)
    return whole + _apart(found, taken)


class Surrogates:
    """Keyed permutations of the values of each shape."""

    def __init__(self, key: bytes):
        self._key = hashlib.blake2b(key, digest_size=32).digest()

    def _random(self, *parts: str | int) -> int:
        data = ",".join(format(p, "x") if isinstance(p, int) else f"{len(p)}:{p}" for p in parts).encode()
        return int.from_bytes(hashlib.blake2b(data, key=self._key, digest_size=64).digest())

    def fingerprint(self, kind: str, canonical: str) -> int:
        """Signed 64 bits that stand for an original without showing it."""
        return int.from_bytes(self._random("id", kind, canonical).to_bytes(64)[:8], signed=True)

    def permuted(self, values: list[int], radices: list[int], domain: str) -> list[int]:
        """Another tuple of the same mixed radices: one cycle through all of them, in keyed order.

        A Feistel network with additions modulo the sizes of both halves numbers the tuples; the
        image of a tuple is the one a keyed step further, which has no divisor in common with their number.
        """
        half = len(radices) // 2
        sizes = [_product(radices[:half]), _product(radices[half:])]
        total = sizes[0] * sizes[1]
        if total < 2:
            return values
        shape = hashlib.blake2b(f"{domain}:{radices}".encode(), digest_size=16).hexdigest()
        sides = [_number(values[:half], radices[:half]), _number(values[half:], radices[half:])]
        for turn in range(ROUNDS):
            side = turn % 2
            sides[side] = (sides[side] + self._random(shape, turn, sides[1 - side])) % sizes[side]
        step = 1 + self._random(shape, "step") % (total - 1)
        while math.gcd(step, total) > 1:
            step = step % (total - 1) + 1
        at = (sides[0] * sizes[1] + sides[1] + step) % total
        sides = list(divmod(at, sizes[1]))
        for turn in reversed(range(ROUNDS)):
            side = turn % 2
            sides[side] = (sides[side] - self._random(shape, turn, sides[1 - side])) % sizes[side]
        return _digits(sides[0], radices[:half]) + _digits(sides[1], radices[half:])

    def shaped(self, text: str, domain: str, hexadecimal: bool = False) -> str:
        """Letters and digits of a canonical text replaced by others of their classes."""
        spots = []  # (place, letters to choose from)
        for at, c in enumerate(text):
            if hexadecimal and c in "0123456789abcdef":
                spots.append((at, "0123456789abcdef"))
            elif c in "0123456789":
                spots.append((at, "0123456789"))
            elif c.lower() in _PLACE:
                letters = ALPHABETS[_PLACE[c.lower()][0]]
                upper = letters.upper()
                spots.append((at, letters if c in letters or len(upper) != len(letters) else upper))
        free = {at for at, _ in spots}
        shape = "".join("#" if at in free else c for at, c in enumerate(text))
        out, before = list(text), f"{domain}:{shape}:{[x[1][0] for x in spots]}"
        for low in range(0, len(spots), LONGEST):
            block = spots[low : low + LONGEST]
            values = [letters.index(text[at]) for at, letters in block]
            for (at, letters), image in zip(block, self.permuted(values, [len(letters) for _, letters in block], before)):
                out[at] = letters[image]
            before = hashlib.blake2b(f"{before}:{values}".encode(), digest_size=16).hexdigest()
        return "".join(out)

    def of(self, kind: str, text: str) -> tuple[str, str]:
        """(canonical form, surrogate in the notation of the text)."""
        return getattr(self, f"_{kind}")(text)

    def of_person(self, person: Person, turn: int = 0) -> list[str]:
        """The words of a person's surrogate, in lower case; with a turn, those of the re-keyed permutations."""
        own = self.again(turn) if turn else self
        words = [own._name(word, first=True) for word in person.words]
        script = "cyrillic" if "а" <= person.words[0][0] <= "ё" else "latin" if person.words[0][0] < "\u0250" else ""
        if person.canonical[1:2] == "~" and script and turn < LISTED_TURNS:
            names = _NAME_LISTS[_LISTS[person.gender, script]]
            words[0] = names[own._random("titled", person.words[0]) % len(names)]
        return words

    def _email(self, text: str) -> tuple[str, str]:
        canonical = text.lower()
        local, _, domain = canonical.partition("@")
        labels = domain.split(".")
        fixed = 2 if labels[-2:-1] == ["example"] else 1  # a reserved name names nobody
        free = ".".join(labels[:-fixed])
        image = self.shaped(f"{local}@{free}", f"email:{'.'.join(labels[-fixed:])}")
        whole = image + domain[len(free) :]
        return canonical, _cased(whole, text)

    def _ip(self, text: str) -> tuple[str, str]:
        octets = text.split(".")
        least = [(0, 10, 100)[len(o) - 1] for o in octets]
        radices = [(10, 90, 156)[len(o) - 1] for o in octets]
        images = self.permuted([int(o) - low for o, low in zip(octets, least)], radices, "ip")
        return text, ".".join(str(image + low) for image, low in zip(images, least))

    def _phone(self, text: str) -> tuple[str, str]:
        country = re.match(r"\+\d{1,3}(?=\D)", text)
        kept = country.end() if country else 0
        digits = re.sub(r"\D", "", text[kept:])
        prefix = text[:kept]
        image = self.shaped(digits, f"phone:{prefix}")
        return f"{prefix}:{digits}", prefix + _refilled(text[kept:], image)

    def _ssn(self, text: str) -> tuple[str, str]:
        return text, self.shaped(text, "ssn")

    def _iban(self, text: str) -> tuple[str, str]:
        canonical = text.replace(" ", "")
        image = canonical[:2] + self.shaped(canonical[2:], f"iban:{canonical[:2]}")
        return canonical, _refilled(text, image)

    def _card(self, text: str) -> tuple[str, str]:
        digits = re.sub(r"\D", "", text)
        body, off = digits[:-1], (int(digits[-1]) - _check_digit(digits[:-1])) % 10
        if off == 0:
            image = self.shaped(body, "card:valid")
            image += str(_check_digit(image))
        else:  # nine wrong check digits, so that it stays invalid
            *front, wrong = self.permuted([*map(int, body), off - 1], [10] * len(body) + [9], "card:invalid")
            image = "".join(map(str, front))
            image += str((_check_digit(image) + wrong + 1) % 10)
        return digits, _refilled(text, image)

    def _secret(self, text: str) -> tuple[str, str]:
        if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
            image = self.shaped(text.lower(), "hex", hexadecimal=True)
            return text.lower(), image.upper() if text.upper() == text else image
        return text, self.shaped(text, "secret")

    def _ip6(self, text: str) -> tuple[str, str]:
        groups = text.lower()
        return groups, _cased(self.shaped(groups, "ip6", hexadecimal=True), text) if text != text.upper() else self.shaped(groups, "ip6", hexadecimal=True).upper()

    def _person(self, text: str) -> tuple[str, str]:
        person = Person(tuple(_folded_name(unicodedata.normalize("NFC", text)).split(" ")))
        return person.canonical, _written(self.of_person(person), text)

    def _name(self, word: str, first: bool) -> str:
        names = _LIST_OF.get(word) if first else None
        if names is None:
            image = self.shaped(word, "name")
            while first and image in _LIST_OF:  # so it is a permutation of the unlisted words
                image = self.shaped(image, "name")
            return image
        order = sorted(names, key=lambda n: self._random("given", names[0], n))
        return order[(order.index(word) + 1) % len(order)]

    def again(self, turn: int) -> "Surrogates":
        """Other permutations, derived from the same key."""
        return Surrogates(self._key + b"#%d" % turn)


def _folded_name(text: str) -> str:
    """Lower case, with one letter for both forms of the small sigma, which are one in upper case."""
    return text.lower().replace("ς", "σ")


def _written(words: list[str], text: str) -> str:
    """The words of a surrogate in the letter case of the text."""
    text = unicodedata.normalize("NFC", text)
    whole = re.sub(r"σ\b", "ς", " ".join(words))
    if len(whole) == len(text):
        return _cased(whole, text)
    return whole.upper() if text.isupper() else whole if text.islower() else whole.title()


def _product(radices: list[int]) -> int:
    total = 1
    for radix in radices:
        total *= radix
    return total


def _number(values: list[int], radices: list[int]) -> int:
    number = 0
    for value, radix in zip(values, radices):
        number = number * radix + value
    return number


def _digits(number: int, radices: list[int]) -> list[int]:
    values = []
    for radix in reversed(radices):
        number, value = divmod(number, radix)
        values.append(value)
    return values[::-1]


def _check_digit(body: str) -> int:
    doubled = [int(d) * (2 - at % 2) for at, d in enumerate(reversed(body))]
    return -sum(d // 10 + d % 10 for d in doubled) % 10


def _cased(image: str, text: str) -> str:
    """The image with upper case where the text has it."""
    return "".join(i.upper() if c.isupper() and len(i.upper()) == 1 else i for i, c in zip(image, text))


def _refilled(text: str, image: str) -> str:
    """The notation of the text with the letters and digits of the image."""
    fill = iter(image)
    return "".join(next(fill) if c.isalnum() else c for c in text)


def replaced(text: str, surrogates: Surrogates, turns: dict[tuple[str, int], int] | None = None) -> tuple[str, list[dict]]:
    """(text with surrogates, entities as kind, place in the new text, fingerprint of the original).

    `turns` says by kind and fingerprint which originals are re-keyed, and how often.
    """
    parts, entities, at, length = [], [], 0, 0
    persons: dict[Person, tuple[int, list[str]]] = {}
    for e in detect(text):
        own = text[e.start : e.end]
        if e.person:
            if e.person not in persons:
                original = surrogates.fingerprint("person", e.person.canonical)
                persons[e.person] = original, surrogates.of_person(e.person, (turns or {}).get(("person", original), 0))
            original, words = persons[e.person]
            folded = _folded_name(unicodedata.normalize("NFC", own)).split()
            mentioned = words if len(folded) > 1 or len(words) == 1 else [words[e.person.words.index(folded[0])]]
            image = _written(mentioned, " ".join(own.split()))
            surrogate = surrogates.fingerprint("person", _folded_name(" ".join(words)))
        else:
            canonical, image = surrogates.of(e.kind, own)
            original = surrogates.fingerprint(e.kind, canonical)
            turn = (turns or {}).get((e.kind, original), 0)
            if turn:
                _, image = surrogates.again(turn).of(e.kind, own)
            surrogate = surrogates.fingerprint(e.kind, surrogates_canonical(e.kind, image))
        parts += [text[at : e.start], image]
        length += e.start - at
        entities.append({"kind": e.kind, "start": length, "end": length + len(image), "original": original, "surrogate": surrogate})
        length += len(image)
        at = e.end
    return "".join(parts) + text[at:], entities


def surrogates_canonical(kind: str, image: str) -> str:
    """What makes two surrogates the same to a reader: letter case and separators do not tell them apart."""
    if kind == "person":
        return _folded_name(image)
    folded = image.lower() if kind == "email" or re.fullmatch("[0-9a-fA-F]+", image) else image
    return folded if kind in ("email", "secret", "ip", "ip6") else "".join(c for c in folded if c.isalnum() or c == "+")


_ENTITY = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("original", T.LongType()), T.StructField("surrogate", T.LongType()),
])
_ARROW = pa.struct([
    ("text", pa.string()),
    ("entities", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("original", pa.int64()), ("surrogate", pa.int64())]))),
])


_TURN = "array<struct<kind:string,original:bigint,turn:int>>"


def _replacing(key: bytes):
    """(text, turns of its re-keyed entities) -> struct of the new text and its entities."""

    @F.arrow_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("entities", T.ArrayType(_ENTITY))]))
    def replace(texts: pa.Array, turns: pa.Array) -> pa.Array:
        surrogates = Surrogates(key)

        def rows() -> Iterator[dict]:
            for text, of_row in zip(texts, turns):
                value = text.as_py()
                own = {(t["kind"], t["original"]): t["turn"] for t in of_row.as_py() or ()}
                new, entities = replaced(value, surrogates, own) if value is not None else (None, [])
                yield {"text": new, "entities": entities}

        return pa.array(list(rows()), _ARROW)

    return replace


def _pairs(replaced_rows: DataFrame) -> DataFrame:
    return replaced_rows.select(F.explode("entities").alias("e")).select("e.kind", "e.original", "e.surrogate").distinct()


def collisions(replaced_rows: DataFrame) -> DataFrame:
    """(kind, surrogate): surrogates that stand for more than one original."""
    return _pairs(replaced_rows).groupBy("kind", "surrogate").agg(F.count("*").alias("n")).filter("n > 1").drop("n")


def _clashing(replaced_rows: DataFrame) -> DataFrame:
    """(kind, original) of all that share a surrogate, but for the smallest of each."""
    least = F.min("original").over(Window.partitionBy("kind", "surrogate"))
    return _pairs(replaced_rows).withColumn("least", least).filter("original > least").select("kind", "original").distinct()


def replace_entities(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, entities), one row for each row of `df`; no surrogate stands for two originals.

    The table is written once. What must be re-keyed is written beside it, and only rows that hold such
    an entity are read and made again; rows are told apart by a hash of id and text, so one that
    shares it with another is at most made again without need.
    """
    ship_package(df.sparkSession)
    source = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("source"))
    source = source.withColumn("row", F.xxhash64(F.col("id").cast("string"), F.col("id").isNull(), "source", F.col("source").isNull()))

    def made(rows: DataFrame, name: str) -> DataFrame:
        opened = rows.select("id", "row", F.inline(F.array(_replacing(key)("source", "turns"))))
        return materialise(opened, name)

    first = made(source.withColumn("turns", F.lit(None).cast(_TURN)), "surrogates")
    rows, turns = first, None
    for _ in range(REKEYS):
        if collisions(rows).isEmpty():
            return rows.select("id", "text", "entities")
        more = _clashing(rows).withColumn("turn", F.lit(1))
        turns = materialise((more if turns is None else turns.unionByName(more)).groupBy("kind", "original").agg(F.sum("turn").cast("int").alias("turn")), "turns")
        held = first.select("row", F.explode("entities").alias("e")).select("row", "e.kind", "e.original").distinct()
        of_row = held.join(turns, ["kind", "original"]).groupBy("row").agg(F.collect_list(F.struct("kind", "original", "turn")).alias("turns"))
        concerned = materialise(of_row, "concerned")
        again = made(source.join(concerned, "row"), "again")
        rows = first.join(concerned.select("row"), "row", "left_anti").select(*first.columns).unionByName(again)
    raise RuntimeError(f"some surrogates still stand for two originals after {REKEYS} rounds")
