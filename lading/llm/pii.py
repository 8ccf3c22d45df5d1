"""Surrogates for personal data (operator 8).

Detected entities (e-mail, phone, IPv4, IPv6, card number, social security
number, IBAN, person names after titles, full names after salutations) are
replaced by keyed surrogates of the same type and format: separators, letter
case, script of letters (Latin, Greek, Cyrillic), country or trunk prefix,
top-level domain, checksum status and the gender of a title stay.

The key is secret: the caller gives it, or ``key_of`` reads the setting
``lading.pii.key`` and without it draws one for the life of the driver.

Numbers and addresses go through a keyed Feistel permutation of the values
that share their format, so one original always gets one surrogate
(coreference, in all documents, with no shared state) and two originals
never the same one (distinctness).  A name is the whole capitalised sequence
after its titles; each part goes through a keyed permutation of the names of its
length and alphabet and is written in syllables of its script with a gendered
ending, so a name has one surrogate per gender in all documents and no two
names share one.  Surrogates have at most 1.5 letters for each letter of a
plain name (3 with accents or digits) and a few more; a word of over 64
letters is replaced by a keyed 128-bit digest in syllables.  The parts are
also replaced wherever they recur in the document, with the gender of their
first title there.  A surrogate that equals an original or another surrogate
of the same document is permuted again, as often as needed; a value whose
format has no free surrogate left in the document gets one of one character
more.  Names that neither a title nor a salutation introduces are not seen.

Defined results: a null text stays null with zero entities; texts without
entities come back byte for byte; repeated rows get equal surrogates; other
columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from lading.llm.rowmap import ROW
from lading.llm.textcols import release, slices

KEY_SETTING = "lading.pii.key"
ROUNDS = 8
LONG_NAME, LONG_TEXT = 64, 128      # letters of a name, characters of a text permuted as one number

# fixed values: entity patterns, titles and the syllables and endings of names
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Mme", "Mlle", "Frau", "Señora", "Señorita", "Madame", "Mademoiselle", "Lady")
MALE_TITLES = ("Mr", "Herr", "Herrn", "Señor", "Monsieur", "Sir")
TITLES = (*FEMALE_TITLES, *MALE_TITLES, "Dr", "Prof", "Professor", "Doctor", "Doktor")
SALUTATIONS = ("Dear", "Liebe", "Lieber")
PARTICLES = ("von", "van", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "la", "le", "zu", "zur", "ter", "bin", "ibn")
TITLE_WORD = "(?:" + "|".join(sorted((t for x in TITLES for t in {x, x.upper()}), key=len, reverse=True)) + r")\b\.?"
CAPITAL = "[A-ZÀ-ÖØ-ÞĀ-ŽΑ-ΩА-ЯЁ]"
PART = rf"{CAPITAL}(?:\w|['’-](?!s\b)(?=\w))+"
BEFORE_PART = rf"(?:(?:{CAPITAL}\.|{'|'.join(PARTICLES)}) )*"
SALUTATION_WORD = "(?:" + "|".join(SALUTATIONS) + ")"
# per script: consonants and vowels of its syllables, endings by gender
SYLLABLES = {"latin": ("bdfghjklmnprstvz", "aeiou", {"f": "na", "m": "no", "n": "ne"}),
             "greek": ("βγδζθκλμνπρστφχ", "αεηιου", {"f": "να", "m": "νος", "n": "νε"}),
             "cyrillic": ("бвгджзклмнпрстфх", "аеиоу", {"f": "на", "m": "нов", "n": "не"})}
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
PATTERNS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\dA-Za-z])(?:\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4}"
             r"|0\d(?:[ .-]\d{2}){4}|0\d{2,4}[ /-]\d{3,4}[ -]\d{3,4}|0\d{2,4}[ /-]\d{5,9})(?![\d])",
    "ip6": r"(?<![\w:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\w:])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "card": r"(?<![\dA-Za-z])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{13,19})(?![\dA-Za-z])",
    "name": (rf"(?<!\w)(?:(?:{SALUTATION_WORD} )?(?:{TITLE_WORD} ){{1,8}}{BEFORE_PART}{PART}(?: {BEFORE_PART}{PART})*"
             rf"|{SALUTATION_WORD} {PART}(?: {BEFORE_PART}{PART})+)"),
}


class Names:
    """The surrogate names of a gender: syllables of a script and the gender's ending."""

    def __init__(self, gender: str):
        self.form = re.compile("(?i:" + "|".join(f"(?:[{c}][{v}])+{e[gender]}" for c, v, e in SYLLABLES.values()) + ")")

    def __contains__(self, name: str) -> bool:
        return self.form.fullmatch(name) is not None


NAMES = {gender: Names(gender) for gender in "fmn"}
ENTITY = re.compile("|".join(f"(?P<{k}>{re.sub(r'\(\[ -\]\)', '(?P<sep>[ -])', p).replace(chr(92) + '1', '(?P=sep)')})"
                             for k, p in PATTERNS.items()))
TITLES_OF_NAME = re.compile(rf"(?:{SALUTATION_WORD} )?(?:{TITLE_WORD} ){{0,8}}")
WORD_OF_NAME = re.compile(r"[^\W_]+")
TITLE = re.compile(rf"(?:{TITLE_WORD}|{SALUTATION_WORD}) ".replace(r"\b", "").encode())

RESULT = [StructField("text", StringType()), StructField("n_entities", LongType()),
          StructField("entities", ArrayType(StructType([
              StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()),
              StructField("surrogate", StringType())])))]
_ENTITIES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())]))


def _noise(key: bytes, label: str, value: int, bound: int) -> int:
    size = (bound.bit_length() + 7) // 8 + 8
    out = b""
    while len(out) < size:
        out += hashlib.blake2b(f"{label}|{value}|{len(out)}".encode(), key=key[:64], digest_size=64).digest()
    return int.from_bytes(out[:size], "big") % bound


def permute(value: int, left: int, right: int, key: bytes, label: str) -> int:
    """A keyed permutation of range(left * right)."""
    a, b = divmod(value, right)
    for r in range(ROUNDS):
        a = (a + _noise(key, f"{label}|{r}|a", b, left)) % left
        b = (b + _noise(key, f"{label}|{r}|b", a, right)) % right
    return a * right + b


def _alphabet(ch: str) -> tuple[int, int]:
    """First code point and size of the set a character is replaced in: its
    digit, case and script class; size 1 keeps it."""
    c = ord(ch)
    if 48 <= c <= 57:
        return 48, 10
    if 65 <= c <= 90:
        return 65, 26
    if 97 <= c <= 122:
        return 97, 26
    if 0x3B1 <= c <= 0x3C9 and c != 0x3C2:
        return 0x3C3 if c >= 0x3C3 else 0x3B1, 7 if c >= 0x3C3 else 17
    if 0x410 <= c <= 0x42F:
        return 0x410, 32
    if 0x430 <= c <= 0x44F:
        return 0x430, 32
    return c, 1


def permute_text(text: str, key: bytes, label: str) -> str:
    """Every letter and digit replaced in its class; one-to-one on the texts
    that share this pattern of classes.  Long texts go block by block."""
    if len(text) > LONG_TEXT:
        return "".join(permute_text(text[i:i + LONG_TEXT], key, f"{label}|{i}") for i in range(0, len(text), LONG_TEXT))
    sets = [_alphabet(c) for c in text]
    sizes = [n for _, n in sets if n > 1]
    if not sizes:
        return text
    half = (len(sizes) + 1) // 2
    left, right = 1, 1
    for n in sizes[:half]:
        left *= n
    for n in sizes[half:]:
        right *= n
    value = 0
    for c, (first, n) in zip(text, sets):
        if n > 1:
            value = value * n + ord(c) - first
    pattern = "".join(chr(first) if n > 1 else c for c, (first, n) in zip(text, sets))
    value = permute(value, left, right, key, f"{label}|{pattern}")
    out = []
    for c, (first, n) in zip(reversed(text), reversed(sets)):
        if n > 1:
            value, d = divmod(value, n)
            c = chr(first + d)
        out.append(c)
    return "".join(reversed(out))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def surrogate(kind: str, text: str, key: bytes) -> str:
    """The replacement of one entity (names: see ``name_surrogate``)."""
    if kind == "email":
        head, dot, tld = text.rpartition(".")
        return permute_text(head, key, kind) + dot + tld
    if kind == "phone" and text[0] == "+":
        country = re.match(r"\+\d{1,3}(?=[ .(-])|\+\d", text).group()
        return country + permute_text(text[len(country):], key, kind + country)
    if kind == "phone" and text[0] == "0":
        return "0" + permute_text(text[1:], key, kind + "0")
    if kind == "ip6":
        digits = re.sub(":", "", text)
        half = len(digits) // 2
        shape = re.sub(r"\w", "0", text)
        new = iter(f"{permute(int(digits, 16), 16 ** half, 16 ** (len(digits) - half), key, f'{kind}|{shape}'):0{len(digits)}x}")
        out = "".join(c if c == ":" else next(new) for c in shape)
        return out.upper() if text.isupper() else out
    if kind == "ip":
        value = 0
        for part in text.split("."):
            value = value * 256 + int(part)
        value = permute(value, 1 << 16, 1 << 16, key, kind)
        return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))
    if kind == "iban":
        return text[:2] + permute_text(text[2:], key, kind + text[:2])
    if kind == "card":
        valid = _luhn(re.sub(r"\D", "", text))
        while True:                                  # walk the cycle to the next of the same status
            text = permute_text(text, key, kind)
            if _luhn(re.sub(r"\D", "", text)) == valid:
                return text
    return permute_text(text, key, kind)


def _letters(name: str) -> tuple[str, int, int, list[int]]:
    """Script a name is replaced in, the number of its alphabet among the
    three of the script, the alphabet's size and the letters' places in it."""
    points = [ord(c) for c in name]
    if all(97 <= c <= 122 for c in points):
        return "latin", 0, 26, [c - 97 for c in points]
    if all(c == 0x390 or 0x3AC <= c <= 0x3CE for c in points):
        return "greek", 0, 36, [max(c - 0x3AB, 0) for c in points]
    if all(0x430 <= c <= 0x45F for c in points):
        return "cyrillic", 0, 48, [c - 0x430 for c in points]
    if all(48 <= c <= 57 or 97 <= c <= 122 or 0xDF <= c <= 0x17F for c in points):     # digits, letters, letters with accents
        return "latin", 1, 197, [c - 48 if c <= 57 else c - 87 if c <= 122 else c - 187 for c in points]
    script = next((s for s, lo, hi in (("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F)) if any(lo <= c <= hi for c in points)), "latin")
    return script, 2, 0x110000, points


@lru_cache(1 << 16)
def name_surrogate(name: str, gender: str, key: bytes) -> str:
    """The replacement of one word of a name, whatever its case; one-to-one.
    The word is permuted among the words of its length and alphabet, and the
    result is written in syllables of its script."""
    script, alphabet, size, letters = _letters(name.lower())
    consonants, vowels, endings = SYLLABLES[script]
    n, value = len(letters), 0
    if n > LONG_NAME:
        value, alphabet, shorter = int.from_bytes(hashlib.blake2b(name.lower().encode(), key=key[:64], digest_size=16).digest(), "big"), 3, 0
    else:
        for d in letters:
            value = value * size + d
        value = permute(value, size ** (n // 2), size ** (n - n // 2), key, f"name|{script}|{alphabet}|{n}")
        shorter = sum(size ** k for k in range(1, n))
    syllables = len(consonants) * len(vowels)
    value = (value + shorter) * 4 + alphabet + syllables + 1     # shorter words come first; at least two syllables
    out = []
    while value:
        value, d = divmod(value - 1, syllables)
        out.append(consonants[d // len(vowels)] + vowels[d % len(vowels)])
    return "".join(reversed(out)).capitalize() + endings[gender]


def _gender(titles: str) -> str:
    words = {t.rstrip(".").capitalize() for t in titles.split()}
    return "f" if words & set(FEMALE_TITLES) else "m" if words & set(MALE_TITLES) else "n"


def _renamed(name: str, gender: str, of_word: dict[str, str], given: dict[tuple[str, str], str], used: set[str], key: bytes) -> str:
    """A name with its words replaced; particles stay, an initial becomes another.
    ``given`` and ``used``: surrogates of the document's words so far."""
    def one(m: re.Match) -> str:
        word = m.group()
        if word in PARTICLES:
            return word
        if len(word) == 1:
            return permute_text(word, key, "initial")
        own = gender if gender != "n" else of_word.get(word.lower(), "n")
        new = given.get((word.lower(), own))
        if new is None:
            new = name_surrogate(word, own, key)
            while new.lower() in of_word or new in used:        # longer each time, so this ends
                new = name_surrogate(new, own, key)
            given[word.lower(), own] = new
            used.add(new)
        return new.upper() if word.isupper() else new
    return WORD_OF_NAME.sub(one, name)


def _names(text: str, hits: list[tuple[str, int, int]]) -> tuple[dict[str, str], list[tuple[str, int, int]]]:
    """Gender of every word of the document's titled names (lower case), and
    the hits with the places where the words recur outside of hits."""
    of_word: dict[str, str] = {}
    forms: set[str] = set()
    for kind, a, b in hits:
        if kind == "name":
            titles = TITLES_OF_NAME.match(text, a, b)
            gender = _gender(titles.group())
            for word in WORD_OF_NAME.findall(text, titles.end(), b):
                if len(word) > 1 and word not in PARTICLES:
                    if of_word.get(word.lower(), "n") == "n":
                        of_word[word.lower()] = gender
                    forms |= {word, word.upper(), word.capitalize()}
    if forms:
        again = re.compile(r"(?<![^\W_])(?:" + "|".join(sorted(map(re.escape, forms), key=len, reverse=True)) + r")(?![^\W_])")
        out, at = [], 0
        for kind, a, b in [*hits, ("", len(text), len(text))]:
            out += [("name", m.start(), m.end()) for m in again.finditer(text, at, a)]
            out.append((kind, a, b))
            at = b
        hits = out[:-1]
    return of_word, hits


def _free(kind: str, own: str, taken: set[str], key: bytes) -> str:
    """The first surrogate on the way from ``own`` that is not taken.  Where the
    way comes back to ``own``, the format has no more: the value grows by a
    character, an address goes through a permutation of another key."""
    new = surrogate(kind, own, key)
    while new in taken:
        if new == own:
            if kind in ("ip", "ip6"):
                key = hashlib.blake2b(b"again", key=key[:64]).digest()
            else:
                own = "a" + own if kind == "email" else own + "0"
                new = own
        new = surrogate(kind, new, key)
    return new


def replace(text: str, key: bytes) -> tuple[str, list[dict]]:
    """The text with its entities replaced, and the entities: kind, span in
    the original text, surrogate."""
    hits = [(m.lastgroup if m.lastgroup != "sep" else "card", m.start(), m.end()) for m in ENTITY.finditer(text)]
    if not hits:
        return text, []
    of_word, hits = _names(text, hits)
    taken = {text[a:b] for _, a, b in hits}         # originals, then surrogates too
    given: dict[tuple[str, str], str] = {}
    of_part: dict[tuple[str, str], str] = {}
    used_parts: set[str] = set()
    out, at, found = [], 0, []
    for kind, a, b in hits:
        own = text[a:b]
        new = given.get((kind, own))
        if new is None and kind == "name":
            titles = TITLES_OF_NAME.match(own)
            head = titles.group()
            new = head + _renamed(own[len(head):], _gender(head), of_word, of_part, used_parts, key)
        elif new is None:
            new = _free(kind, own, taken, key)
            taken.add(new)
        given[kind, own] = new
        out += [text[at:a], new]
        at = b
        found.append({"kind": kind, "start": a, "end": b, "surrogate": new})
    out.append(text[at:])
    return "".join(out), found


def _suspects(column: pa.Array) -> np.ndarray:
    """Rows that hold a digit, an at sign or a title."""
    out = np.zeros(len(column), dtype=bool)
    for lo, hi, buf, off in slices(column):
        sign = np.concatenate([[0], np.cumsum(((buf >= 48) & (buf <= 57)) | (buf == 64))])
        out[lo:hi] = sign[off[1:]] > sign[off[:-1]]
        raw = buf.tobytes()
        for m in TITLE.finditer(raw):
            out[lo + int(np.searchsorted(off[1:], m.start(), side="right"))] = True
    return out


_DRAWN = secrets.token_bytes(32)


def key_of(spark: SparkSession) -> bytes:
    """The key in the session's settings; without one, a key drawn for the life
    of the driver, so surrogates agree within it and nobody can invert them."""
    given = spark.conf.get(KEY_SETTING, None)
    return hashlib.blake2b(given.encode()).digest() if given else _DRAWN


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``row`` (the input row) with the new ``text``, ``n_entities`` and ``entities``."""
    at = docs.columns.index(text_col)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = batch.column(0)
        text = rows.field(at)
        new, count, entities = {}, np.zeros(len(text), dtype=np.int64), [None] * len(text)
        for i in np.flatnonzero(_suspects(text)).tolist():
            changed, found = replace(text[i].as_py(), key)
            if found:
                new[i], count[i], entities[i] = changed, len(found), found
        mask = pa.array(np.isin(np.arange(len(text)), list(new)))
        done = pc.replace_with_mask(text, mask, pa.array(list(new.values()), text.type)) if new else text
        return pa.RecordBatch.from_arrays([rows, done, pa.array(count), pa.array(entities, _ENTITIES)],
                                          [ROW, "text", "n_entities", "entities"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield one(batch)
            del batch                       # gone before the next one is read
            release()

    typed = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return (typed.select(F.struct(*[typed[f"`{c}`"] for c in typed.columns]).alias(ROW))
            .mapInArrow(run, StructType([StructField(ROW, StructType(typed.schema.fields), False), *RESULT])))


def replace_documents(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with the entities of its texts replaced, all columns kept."""
    done = pseudonymise(docs, key, text_col)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(ROW)[c].alias(c) for c in docs.columns])
