"""PII surrogates: detected entities get keyed replacements of the same type and form.

Kinds: e-mail, phone, IPv4, card number, IBAN, social security number, secret
(value after token, password, key and the like, or a long hex string), person
(capitalised words after a title, after a cue such as "my name is" or a closing, with
a known given name among them, or joined by "and" to such a name; every further mention of these words in the text,
also in capitals). Capitals are letters of Unicode's upper and title case. Scripts without
case have no such sign, so there a name is found only right after a title or cue, as at most ``CASELESS_WORDS`` words, or
``CASELESS_LETTERS`` letters where the script sets no blanks, and further mentions are those of the whole name. A single name word that
opens a sentence is left alone where the text also has it in lower case or it is an ordinary word (``ORDINARY``).
A name with none of these cues anywhere in its text isn't found.

A surrogate is the image of the value under a keyed permutation of all values of
the same form (a Feistel network over the characters that may change, with
cycle walking, around a shift, so that no value is its own surrogate), so:

* type and format stay: digits for digits, letters for letters of the same
  script and case (all scripts; Latin, Cyrillic and Greek by the tables below, others by
  Unicode blocks; a form without any letter or digit is starred out), vowels for vowels in names, separators, lengths, country
  codes, reserved domains; the check digits of cards and IBANs stay as valid or
  invalid as they were, private addresses stay private;
* gender stays: the title and a name's last letter (its gender ending) are kept;
* distinct values stay distinct, and one value has one surrogate in all documents
  (coreference), without a table of entities. Domains and the words of a name
  are replaced word by word, so partial mentions agree too, and a word in capitals gets the
  surrogate of the word in capitals.

The key is the caller's and must stay secret: who has it can turn surrogates back. The registered query takes it from the
session's ``spark.viaduct.pii.key`` and, where that is unset, draws one for the run and forgets it.

`surrogate_documents` notes, beside each text, the hashes of its values and surrogates, in the same pass. `collisions`
groups these by surrogate over the corpus (map-side distinct) and gives those that two values
share; the query reads both from one written table and fails if there are any.

Defined results: null text has no entities and stays null; rows that repeat are
rewritten alike; a null id stays null; an empty table gives an empty result;
other columns are ignored (`pseudonymised` passes them on).
"""

from __future__ import annotations

import hashlib
import re
import secrets
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, map_arrow, staged

KEY_SETTING = "spark.viaduct.pii.key"
CASELESS_WORDS, CASELESS_LETTERS = 2, 3
KINDS = ("email", "phone", "ip", "card", "iban", "ssn", "secret", "person")

# Titles, and domains reserved for examples.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Sir", "Lady", "Herr", "Frau", "Señor", "Señora", "Sr", "Sra", "Monsieur", "Madame", "Mme", "Mlle", "Don", "Doña")
# Words before a name, and given names that are no other words.
CUES = (
    "my name is", "signed by", "best regards", "kind regards", "sincerely", "yours truly", "mein name ist", "ich heiße", "mit freundlichen grüßen",
    "me llamo", "mi nombre es", "atentamente", "je m'appelle", "mon nom est", "cordialement",
)
PARTICLES = ("de", "del", "la", "von", "van", "der", "den", "zu", "di", "da", "du", "le")
GIVEN = frozenset(
    "Alexander Alice Amelia Andrea Andreas Andrew Angela Anna Anne Anthony Antonio Barbara Benjamin Carlos Carmen Catherine Charlotte "
    "Christian Christine Christopher Claudia Daniel David Deborah Diego Dorothy Edward Elena Elizabeth Emily Emma Eric Fernando "
    "François Franz Friedrich George Hannah Hans Helen Henry Isabelle Jacques James Javier Jean Jennifer Jessica Johann John Jonathan "
    "José Joseph Juan Julia Jürgen Karen Katharina Kevin Klaus Laura Linda Lisa Louise Lucía Luis Lukas Manuel Marco Margaret Maria "
    "María Marie Martin Matthew Michael Michel Miguel Monika Nancy Nicholas Nicole Olivia Pablo Patricia Patrick Paul Pedro Peter "
    "Petra Philippe Pierre Rachel Rebecca Richard Robert Sabine Samuel Sandra Sarah Sofia Sophie Stefan Stephanie Stephen Susan "
    "Thomas Timothy Ursula Walter Werner William Wolfgang "
    "Adam Albert Alejandro Amanda Amy Ana Arthur Brian Camille Cecilia Cristina Denise Donald Doris Emilia Erika Ernst Esther "
    "Eva Felix Florian Frances Gabriel Gerhard Gloria Gregory Günter Heinrich Helga Ingrid Isabel Jeffrey Joan Jorge "
    "Joshua Julie Kenneth Kimberly Lorenzo Luisa Margarita Marta Mary Melissa Mercedes Nathalie Oliver Oscar Pauline Rafael Ralph "
    "Roberto Rosa Ruth Ryan Sara Scott Sharon Silvia Teresa Theresa Victor Victoria Vincent Yves".split()
)
# Name words that are ordinary words where they open a sentence.
ORDINARY = frozenset("Will May Mark Grace Rose Hope Faith Joy Art Bill Grant Frank Guy Jack Gene Young Long Short White Black Brown Green King Price Page Rich Day Still So Little".split())
# Words that join two names, and two-digit country codes of telephone numbers (1 and 7 have one digit, the others three).
JOINERS = ("and", "und", "y", "e", "et", "&")
DIAL_TWO = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
)
RESERVED = ("example.com", "example.org", "example.net", "test", "invalid", "localhost")

# Letters that stand for each other, by script, case and sound.
ALPHABETS = (
    "0123456789", "aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUY", "BCDFGHJKLMNPQRSTVWXZ",
    "àáâãäåèéêëìíîïòóôõöùúûü", "çñß", "ÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜ", "ÇÑ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)


def _further() -> tuple[str, ...]:
    """All other letters and digits by script, case and block; a group too small joins others of its case."""
    known = {c for a in ALPHABETS for c in a}
    groups: dict[tuple, list[str]] = {}
    for code in range(128, sys.maxunicode + 1):
        c = chr(code)
        if c.isalnum() and c not in known:
            case, script = unicodedata.category(c), unicodedata.name(c, "").split(" ")[0]
            if case == "Nd":
                block = code - unicodedata.digit(c)
            else:
                block = 0 if script in ("CJK", "HANGUL") else code >> 8
            groups.setdefault((case, script, block), []).append(c)
    small: dict[str, list[str]] = {}
    for case, _, _ in (k for k, g in groups.items() if len(g) < 4):
        small[case] = []
    for key in [k for k, g in groups.items() if len(g) < 4]:
        small[key[0]] += groups.pop(key)
    return tuple("".join(g) for g in [*groups.values(), *small.values()])


ALPHABETS += _further()
_CLASS = {c: a for a in ALPHABETS for c in a}
_PLACE = {c: i for a in ALPHABETS for i, c in enumerate(a)}
_FORM = {a: f"{i}," for i, a in enumerate(ALPHABETS)}
_HEX = "0123456789abcdef"

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_NUMBER = re.compile(
    rf"(?<![\w.])(?:(?P<ip>{_OCTET}(?:\.{_OCTET}){{3}})(?!\.?\d)"
    r"|(?P<card>\d{13,19}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,3})?)"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<phone>\+(?=(?:[ .()-]{0,2}\d){8,15}(?!\d))\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}))(?![\w])"
)
_EMAIL = re.compile(r"(?P<email>[\w%+-]+(?:\.[\w%+-]+)*@[\w-]+(?:\.[\w-]+)+)")
_SECRET = re.compile(
    r"(?i:\b(?:token|secret|password|passwd|pwd|(?:api|access|secret)[_-]?key)\b[\"']?\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9+/_.~-]{6,}={0,2})"
    r"|(?<![\w])(?P<hex>[0-9a-f]{32,128})(?![\w])"
)
_IBAN = re.compile(r"(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)")


def _letters(*categories: str) -> str:
    """The inside of a character class: all letters of these Unicode categories, as ranges."""
    out, start, last = [], None, -2
    for code in [*(c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in categories), -1]:
        if code != last + 1 and start is not None:
            out.append(re.escape(chr(start)) + (f"-{re.escape(chr(last))}" if last > start else ""))
        if code != last + 1:
            start = code
        last = code
    return "".join(out)


# Scripts written without blanks between words: Han, kana, Thai, Lao, Khmer, Burmese.
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
_CAPITAL, _CASELESS = _letters("Lu", "Lt"), _letters("Lo")
_NAME_WORD = rf"[{_CAPITAL}][^\W\d_]+"
_LINK = rf"[ -](?:(?:{'|'.join(PARTICLES)})[ -])*"
_CAPITALISED = rf"{_NAME_WORD}(?:{_LINK}{_NAME_WORD})*"
_SPACED = rf"(?![{_UNSPACED}])[{_CASELESS}]\w{{1,14}}(?!\w)"
_NAME = rf"(?P<person>{_CAPITALISED}|[{_UNSPACED}]{{2,{CASELESS_LETTERS}}}|{_SPACED}(?: {_SPACED}){{0,{CASELESS_WORDS - 1}}})"
_PERSON = re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\b\.?\s+{_NAME}")
_CUE = re.compile(rf"(?<!\w)(?i:{'|'.join(CUES)})[:,]?\s+{_NAME}")
_CAPITALS = re.compile(rf"(?<!\w){_NAME_WORD}(?:{_LINK}{_NAME_WORD})+")
_JOINED = re.compile(rf" (?:{'|'.join(JOINERS)}) (?P<person>{_NAME_WORD}(?:{_LINK}{_NAME_WORD})+)")
_NAME_PART = re.compile(r"[^ -]+")
_CASED = re.compile(rf"[{_CAPITAL}]")
_OPENS = re.compile(r"(?:^|[.!?:\n\"“”«»]\s*)\Z")
_WORDS = re.compile(r"[^\W\d_]+")


def _persons(text: str) -> Iterator[tuple[int, int]]:
    """Names after titles and cues, with a known given name, and the further mentions of their words."""
    spans = [m.span("person") for m in _PERSON.finditer(text)]
    low = text.lower()
    if any(c in low for c in CUES):
        spans += [m.span("person") for m in _CUE.finditer(text)]
    for m in _CAPITALS.finditer(text):
        at = next((w.start() for w in _NAME_PART.finditer(m[0]) if w[0] in GIVEN), None)
        if at is not None and (" " in m[0][at:] or "-" in m[0][at:]):
            spans.append((m.start() + at, m.end()))
    if not spans:
        return
    todo = list(spans)
    while todo:
        if m := _JOINED.match(text, todo.pop()[1]):
            spans.append(m.span("person"))
            todo.append(m.span("person"))
    yield from spans
    names = {text[start:end] for start, end in spans}
    words = {w for n in names if _CASED.search(n) for w in _NAME_PART.findall(n)} - set(PARTICLES)
    if words:
        word = "|".join(re.escape(w) for w in sorted(words | {w.upper() for w in words}, key=len, reverse=True))
        plain: set[str] | None = None
        for m in re.finditer(rf"(?<!\w)(?:{word})(?:[ -](?:{word}))*(?!\w)", text):
            if m[0].isalpha() and _OPENS.search(text, max(0, m.start() - 8), m.start()):
                if plain is None:
                    plain = {w for w in _WORDS.findall(text) if w.islower()}
                if m[0] in ORDINARY or m[0].lower() in plain:
                    continue
            yield m.span()
    whole = {n for n in names if not _CASED.search(n)}
    if whole:
        name = "|".join(map(re.escape, sorted(whole, key=len, reverse=True)))
        ends = rf"(?:(?<![^\W{_UNSPACED}])(?:{name})(?![^\W{_UNSPACED}]))"
        yield from (m.span() for m in re.finditer(ends, text))


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the entities of a text, not overlapping, in order."""
    found: list[tuple[int, int, str]] = []
    searches = [(_NUMBER, True), (_EMAIL, "@" in text), (_SECRET, True), (_IBAN, True)]
    for pattern, worth in searches:
        if worth:
            for m in pattern.finditer(text):
                kind = m.lastgroup or ""
                found.append((*m.span(kind), "secret" if kind == "hex" else kind))
    found += [(*span, "person") for span in _persons(text)]
    rank = {k: i for i, k in enumerate(("email", "secret", "iban", "ip", "card", "ssn", "phone", "person"))}
    # By rank, then place: an entity that meets one that is taken gives way. Those taken stay sorted and don't overlap.
    starts: list[int] = []
    out: list[tuple[int, int, str]] = []
    for start, end, kind in sorted(found, key=lambda e: (rank[e[2]], e[0], -e[1])):
        at = bisect_left(starts, start)
        if (at == 0 or out[at - 1][1] <= start) and (at == len(out) or out[at][0] >= end):
            starts.insert(at, start)
            out.insert(at, (start, end, kind))
    return out


class Surrogates:
    """Keyed permutations of the values of each kind."""

    def __init__(self, key: str) -> None:
        if not key:
            raise ValueError("surrogates need a secret key")
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()
        self.known: dict[tuple[str, str], str] = {}

    def permute(self, number: int, size: int, tweak: str, back: bool = False) -> int:
        """A keyed permutation of 0 .. size - 1, or its inverse."""
        half = max((size - 1).bit_length() + 1 >> 1, 1)
        mask = (1 << half) - 1
        label = tweak.encode("utf-8", "surrogatepass")
        while True:
            left, right = number >> half, number & mask
            for r in reversed(range(8)) if back else range(8):
                message = label + b"\0" + bytes([r]) + (left if back else right).to_bytes((half + 7) // 8, "little")
                digest = hashlib.blake2b(message, key=self.key, digest_size=min(64, (half + 7) // 8 + 8)).digest()
                mixed = int.from_bytes(digest, "little") & mask
                left, right = (right ^ mixed, left) if back else (right, left ^ mixed)
            number = left << half | right
            if number < size:
                return number

    def derange(self, number: int, size: int, tweak: str) -> int:
        """A keyed permutation of 0 .. size - 1 (two or more) that moves every number."""
        step = 1 + self.permute(0, size - 1, tweak + "|step") if size > 2 else 1
        return self.permute((self.permute(number, size, tweak) + step) % size, size, tweak, back=True)

    def shape(self, value: str, tweak: str, alphabets: Callable[[str], str | None] = _CLASS.get, same: Callable[[str], object] | None = None) -> str:
        """Another string of the same form; ``same`` is a property that it shares."""
        sets = [alphabets(c) for c in value]
        size = 1
        for a in sets:
            size *= len(a) if a else 1
        form = "".join(_FORM.get(a, "x,") if a else c for a, c in zip(sets, value, strict=True))
        number = 0
        for a, c in zip(sets, value, strict=True):
            if a:
                number = number * len(a) + (a.index(c) if a is _HEX else _PLACE[c])
        while True:
            number = self.derange(number, size, f"{tweak}|{form}") if size > 1 else number
            rest, out = number, []
            for a, c in zip(reversed(sets), reversed(value), strict=True):
                if a:
                    rest, digit = divmod(rest, len(a))
                    out.append(a[digit])
                else:
                    out.append(c)
            result = "".join(reversed(out))
            if same is None or same(result) == same(value):
                return result

    def email(self, value: str) -> str:
        local, _, domain = value.rpartition("@")
        reserved = next((r for r in RESERVED if domain.lower() == r or domain.lower().endswith("." + r)), "")
        labels = domain.split(".")
        keep = len(reserved.split(".")) if reserved else 1
        changed = [self.shape(x, "domain") for x in labels[:-keep]] + labels[-keep:]
        return self.shape(local, f"email|{domain}") + "@" + ".".join(changed)

    def phone(self, value: str) -> str:
        start = 0
        if value[0] == "+":
            start = 2 if value[1] in "17" else 3 if value[1:3] in DIAL_TWO else 4
        return value[:start] + self.shape(value[start:], "phone" + value[:start])

    def ip(self, value: str) -> str:
        number = 0
        for x in value.split("."):
            number = number << 8 | int(x)

        def range_of(n: int) -> int:
            a, b = n >> 24, n >> 16 & 255
            return 1 if a == 10 else 2 if a == 172 and 16 <= b < 32 else 3 if a == 192 and b == 168 else 4 if a == 127 else 0 if 0 < a < 224 else 5

        now = self.derange(number, 1 << 32, "ip")
        while range_of(now) != range_of(number):
            now = self.derange(now, 1 << 32, "ip")
        return ".".join(str(now >> s & 255) for s in (24, 16, 8, 0))

    def card(self, value: str) -> str:
        def check(body: str) -> int:
            digits = [int(c) for c in body if c.isdigit()][::-1]
            return -sum(sum(divmod(2 * d, 10)) if i % 2 == 0 else d for i, d in enumerate(digits)) % 10

        body, last = value[:-1], int(value[-1])
        new = value[0] + self.shape(body[1:], "card" + value[0])
        return new + str((check(new) + last - check(body)) % 10)

    def iban(self, value: str) -> str:
        def valid(v: str) -> bool:
            v = v.replace(" ", "")
            return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1

        if valid(value):
            # Check digits follow from the rest.
            rest = self.shape(value[4:], "iban" + value[:2])
            number = int("".join(str(int(c, 36)) for c in rest.replace(" ", "") + value[:2] + "00"))
            return value[:2] + f"{98 - number % 97:02d}" + rest
        return value[:2] + self.shape(value[2:], "iban!" + value[:2], same=lambda v: valid(value[:2] + v))

    def ssn(self, value: str) -> str:
        return self.shape(value, "ssn")

    def secret(self, value: str) -> str:
        if set(value) <= set(_HEX):
            return self.shape(value, "hex", lambda c: _HEX)
        return self.shape(value, "secret", lambda c: _CLASS.get(c))

    def person(self, value: str) -> str:
        return "".join(self.name_word(w) if w.isalpha() else w for w in re.split(r"([ -])", value) if w)

    def name_word(self, word: str) -> str:
        """The last letter stays; a word in capitals is replaced as the word with one capital is, where that can be told back."""
        title = word.capitalize()
        if len(word) > 1 and word.isupper() and title.upper() == word:
            new = self.name_word(title)
            if new.upper().capitalize() == new and len(new.upper()) == len(new):
                return new.upper()
        return self.shape(word[:-1], "name" + word[-1]) + word[-1]

    def replace(self, kind: str, value: str) -> str:
        found = self.known.get((kind, value))
        if found is None:
            if len(self.known) >= 100_000:
                self.known.clear()
            found = getattr(self, kind)(value)
            # A form without letters and digits has one value.
            found = self.known[kind, value] = found if found != value else "*" * len(value)
        return found

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and (kind, value, surrogate) in order."""
        out, at, log = [], 0, []
        for start, end, kind in entities(text):
            value = text[start:end]
            new = self.replace(kind, value)
            out += [text[at:start], new]
            at = end
            log.append((kind, value, new))
        return "".join(out) + text[at:] if log else text, log


def _digest(value: str) -> bytes:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def collisions(documents_: DataFrame) -> DataFrame:
    """(kind, surrogate, n): surrogates that several distinct values share, from the ``log`` of `surrogate_documents`; empty if all is well."""
    found = documents_.select(F.inline("log")).distinct()
    return found.groupBy("kind", "surrogate").agg(F.count("*").alias("n")).where("n > 1")


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in its texts, all other columns as they are."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Surrogates(key)
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [by.rewrite(t)[0] if t else t for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return map_arrow(docs, scan, docs.schema)


_LOG = pa.list_(pa.struct([("kind", pa.string()), ("surrogate", pa.binary()), ("value", pa.binary())]))


def surrogate_documents(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_entities, n_<kind> of each kind, the rewritten text, and log: (kind, surrogate, value) of its distinct entities, hashed."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Surrogates(key)
        for batch in batches:
            texts, counts, logs = [], [], []
            for text in batch.column("text").to_pylist():
                new, log = by.rewrite(text) if text else (text, [])
                kinds = [k for k, _, _ in log]
                texts.append(new)
                counts.append([len(kinds)] + [kinds.count(k) for k in KINDS])
                logs.append([{"kind": k, "surrogate": _digest(s), "value": _digest(v)} for k, v, s in dict.fromkeys(log)])
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)] or [pa.array([], pa.int64())] * (len(KINDS) + 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(texts, pa.string()), pa.array(logs, _LOG)], names)

    names = ["doc_id", "n_entities", *(f"n_{k}" for k in KINDS), "text", "log"]
    kinds = ", ".join(f"{n} long" for n in names[:-2]) + ", text string, log array<struct<kind: string, surrogate: binary, value: binary>>"
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return map_arrow(rows, scan, kinds)


def op10_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    key = spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)
    done = staged(surrogate_documents(documents(spark, sf_dir), key), "pii")
    shared = collisions(done).first()
    if shared is not None:
        raise ValueError(f"{shared['n']} values of kind {shared['kind']} share one surrogate")
    return done.drop("log")
