"""Personal data replaced by keyed surrogates of the same type, gender, script and format.

Detection runs once over whole texts: e-mail addresses, payment cards with a valid check digit, phone
numbers, IPv4 addresses, social security numbers, IBANs with valid check digits, and names. A name is

* a given name of the list, or a title, with the name after it;
* one or two capitalised words after a cue ("my name is", "Dear", "author:");
* two or three different capitalised words in a row, with initials and particles, none of which is a common
  capitalised word (months, places, institutions, function words), where capitals are rare: in
  texts in which more than a fifth of the words within sentences are capitalised (German prose, headlines) only the first two count;
* every further mention, in this or all capitals, of a name so found in the document.

Scripts without capitals have names after cues only if these are Latin or Cyrillic; others are not found.
Every entity has a canonical value, so the same one gets the same surrogate in
all documents (coreference); names are replaced word by word, so a surname alone stays
the surname. Digits become digits, vowels vowels, consonants consonants of the same
script, other letters letters near them in Unicode; check digits are made valid. A listed given name becomes another of its
gender and script; the last letter of other names, which often tells the gender, stays. Capitals stay
where they were.

Collision checks: the distinct entities of the corpus form a table; a surrogate that
equals a real entity of its type (given names of all genders are one type here), or another's surrogate, is drawn again, with
more letters or digits after some rounds, until none does, which so ends for any corpus.
The table is built with equi-joins and grows with distinct entities. Only documents with
entities (and the few others that a bit array of 8 MB, filled with hashes of these, lets pass) are
joined with their surrogates; the others are passed through where they are read.

Nulls: a null text stays null with no entities; null ids are carried. Empty texts stay.
Repeated rows give repeated results. Columns besides text and n_chars pass through under any name (one named n_entities is
renamed n_entities_kept where counts are asked for). An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, sieve

# Given names by gender and script, and titles by gender.
GIVEN = {
    "f_latin": "Alice Anna Carla Carmen Charlotte Claire Clara Elena Elizabeth Emily Emma Hannah Ingrid Isabel Jane Jennifer Julia Karin Katharina Laura Linda Lucia Maria Marie Martha Mary Monika Olivia Patricia Sabine Sarah Sophie Susan Ursula".split(),
    "m_latin": "Andreas Antonio Carlos Charles Daniel David Diego Edward Fernando Francisco Frank George Hans Henri Jacques James Jean John Jorge Joseph Jürgen Karl Louis Luis Manuel Michael Miguel Paul Peter Philippe Pierre Robert Stefan Thomas William Wolfgang".split(),
    "f_cyrillic": "Анна Екатерина Елена Ирина Людмила Мария Наталья Ольга Светлана Татьяна".split(),
    "m_cyrillic": "Александр Алексей Андрей Дмитрий Иван Михаил Николай Павел Сергей Юрий".split(),
}
TITLES = {"f": "Frau Madame Miss Mme Mrs Mrs. Ms Ms. Señora Sra.".split(), "m": "Herr Monsieur Mr Mr. Señor Sr.".split()}
SETS = (("aeiou", "bcdfghjklmnpqrstvwxyz"), ("аеиоуыэюя", "бвгджзклмнпрстфхцчшщ"))

KIND = {n.casefold(): f"given_{k}" for k, names in GIVEN.items() for n in names}
STARTS = frozenset(n for names in GIVEN.values() for n in names) | frozenset(t for ts in TITLES.values() for t in ts)
_PATTERNS = (
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,}")),
    ("iban", re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\w|\.\d)")),
    ("card", re.compile(r"(?<![\w.+-])\d+(?:[ -]\d+)*(?![\w-])")),  # runs of groups, see cards()
    ("ssn", re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.+-])(?:(\+\d{1,3})[ .-]?)?(?:\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?![\w-])|(?<![\w.+-])(\+\d{1,3})(?:[ .-]?\d{2,4}){2,5}(?![\w-])")),
)
_DIGITS = re.compile(r"(?:\d[^\d\n]{0,3}?){7}")
_WORD = re.compile(r"\w+")
TITLED = frozenset(t for ts in TITLES.values() for t in ts)
_FIRST = frozenset(s.rstrip(".") for s in STARTS)
#: Capital and small letters of the Latin, Greek and Cyrillic blocks.
UPPER = "".join(chr(c) for c in range(0x41, 0x530) if chr(c).isupper())
SMALL = "".join(chr(c) for c in range(0x61, 0x530) if chr(c).islower())
_W = f"[{UPPER}][{SMALL}]+(?:[{UPPER}][{SMALL}]+)?"
_W = f"(?:[{UPPER}]['\u2019])?{_W}(?:-{_W})*"
_NAME = re.compile(rf"(?<!\w)({'|'.join(map(re.escape, sorted(STARTS, key=len, reverse=True)))})\s({_W})(?!\w)(?:\s({_W})(?!\w))?")
_FULL = re.compile(rf"(?<![\w'])({_W})((?: (?:[{UPPER}]\.|van|von|der|den|de|del|di|da|dos|bin|ibn|al|la|le))*) ({_W})(?!\w)(?: ({_W})(?!\w))?")
# Words that come before a name, and capitalised words that are no names.
CUES = (
    "my name is|name:|called|named|i am|i'm|this is|dear|hello|hi|signed|sincerely,|regards,|author:|written by|contact:|patient:|customer:|attn:|from:|to:|cc:"
    "|mein name ist|ich heiße|ich bin|liebe|lieber|je m'appelle|mon nom est|cher|chère|me llamo|mi nombre es|querido|querida|меня зовут|уважаемый|уважаемая"
)
NOT_NAMES = frozenset(
    "The A An And Or But If In On At By For From To Of With As Is Are Was Were Be This That These Those It He She We You They I My Our Your His Her Their What When Where Who Why How No Not Yes All "
    "Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December "
    "New North South East West Northern Southern Eastern Western Central Upper Lower Great Saint San Santa Los Las Mount Lake River Street Road Avenue Park City Island Islands County State States United Kingdom Republic "
    "America American Europe European Asia Africa England English France French Germany German Spain Spanish Russia Russian China Chinese Japan Japanese India Indian London Paris Berlin Madrid York "
    "University College School Institute Department Ministry Court Party Act Law Company Bank Church Museum Hospital Press News Times World War Union Army House Chapter Section Table Figure Part Volume Internet Google Microsoft Windows "
    "License Licence Licensed Copyright Public General Version Apache Software Foundation Creative Commons Attribution Rights Reserved Terms Service Privacy Policy Agreement Notice Office "
    "Ask Call Tell See Meet Contact Email Mail Dear Hello Hi Thanks Thank Please Write Visit Read Yesterday Today Tomorrow Then There Here Also After Before While Since Until Both Each Every "
    "Sir Madam Customer Team Friend Friends Everyone Doctor Professor President Minister King Queen God Lord Christmas Easter "
    "Der Die Das Ein Eine Und Im Am Le La Les Un Une Des El Los Una En De Du Et Y".split()
)
_CUE = re.compile(rf"(?<!\w)(?i:{CUES})\s+({_W})(?!\w)(?:\s({_W})(?!\w))?")
_CAPITAL = re.compile(rf"(?<!\w)[{UPPER}][{SMALL}]")
_AFTER = re.compile(rf" [{UPPER}][{SMALL}]")
_START = re.compile(r"(?:[.!?:;][\"')]? *|\n *)\Z")
_GOES_ON = re.compile(rf",|['\u2019]s|(?: \(| )[{SMALL}]")
#: Words that go on a sentence, with their capitals.
_WITHIN = re.compile(rf"(?<=[\w,;] )([{UPPER}]?)[{SMALL}]+")


def luhn(digits: str) -> int:
    """Sum of a digit string that ends in its check digit, modulo 10; 0 if valid."""
    d = [int(x) for x in reversed(digits)]
    return (sum(d[0::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def cards(run: str) -> list[tuple[int, int]]:
    """Spans of card numbers in digit groups joined by single spaces or hyphens: 13 to 19 digits in any grouping by one separator.

    Groups but the last have three digits or more; of numbers that share groups, the first and longest counts.
    """
    groups = [m.span() for m in re.finditer(r"\d+", run)]
    out, i = [], 0
    while i < len(groups):
        best, digits, j = None, 0, i
        while j < len(groups) and digits <= 19:
            a, b = groups[j]
            if j - i > 1 and run[a - 1] != run[groups[i][1]]:
                break  # another separator
            digits += b - a
            if 13 <= digits <= 19 and run[groups[i][0] - 1 : groups[i][0]] != "-" and run[b : b + 1] != "-":
                if luhn(re.sub(r"\D", "", run[groups[i][0] : b])) == 0:
                    best = j
            if b - a < 3:
                break
            j += 1
        if best is not None:
            out.append((groups[i][0], groups[best][1]))
            i = best
        i += 1
    return out


def script(word: str) -> str:
    return "cyrillic" if "\u0400" <= word[:1] <= "\u052f" else "latin"


def given(word: str) -> str:
    """The kind of a given name: its gender and script if it is listed."""
    return KIND.get(word.casefold()) or f"given_n_{script(word)}"


def inner(words: list[str]) -> list[str]:
    """words without those at the ends that are no names; none if such a word is left between, or the words are a title and one name."""
    while words and (words[0] in NOT_NAMES or words[0] in TITLED):
        words = words[1:]
    while words and words[-1] in NOT_NAMES:
        words = words[:-1]
    return words if NOT_NAMES.isdisjoint(words) else []


def rows_of_capitals(text: str) -> list[list[str]]:
    """Rows of two or three different capitalised words that may be names; longer rows are headlines.

    At the start of a sentence the row must not be all of it: the sentence goes on in small letters, or after a comma or an apostrophe.
    """
    out, past = [], -1
    for m in _FULL.finditer(text):
        before, end = past, m.end()
        past = end
        if before == m.start() - 1 or _AFTER.match(text, end):
            continue
        words = inner([x for x in (m[1], m[3], m[4]) if x])
        if len(words) < 2 or len(set(words)) < len(words):
            continue
        if (m.start() == 0 or _START.search(text, max(0, m.start() - 3), m.start())) and not _GOES_ON.match(text, end):
            continue
        out.append(words)
    return out


def names(text: str) -> list[tuple[int, int, str, str]]:
    """Names, and every further mention of their words."""
    if not _CAPITAL.search(text):
        return []
    parts: dict[str, str] = {}  # words of names, and their kinds

    def add(word: str | None, kind: str) -> None:
        if word and word not in NOT_NAMES:
            parts.setdefault(word, kind)

    if not _FIRST.isdisjoint(_WORD.findall(text)):
        for m in _NAME.finditer(text):
            first, second, third = m.groups()
            if first.casefold() in KIND:
                add(first, given(first))
                add(second, "surname")
                if third and third not in NOT_NAMES:
                    add(third, "surname")
            else:  # a title
                add(second, given(second) if third and third not in NOT_NAMES else "surname")
                add(third, "surname")
    for m in _CUE.finditer(text):
        first, second = m.groups()
        if first not in NOT_NAMES:
            add(first, given(first))
            add(second, "surname")
    full = rows_of_capitals(text)
    if full:
        capital = [m[1] != "" for m in _WITHIN.finditer(text)]
        if sum(capital) - 2 * len(full) <= 0.2 * len(capital):
            for first, second, *third in full:
                add(first, given(first))
                add(second, given(second) if third and second.casefold() in KIND else "surname")
                for x in third:
                    add(x, "surname")
    if not parts:
        return []
    forms = {x: x for x in parts} | {x.upper(): x for x in parts if len(x) > 2}
    again = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(forms, key=len, reverse=True))) + r")(?!\w)")
    return [(*m.span(), parts[forms[m.group()]], forms[m.group()].casefold()) for m in again.finditer(text)]


def detect(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical value) of entities, in order and disjoint."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    digits = _DIGITS.search(text)
    for kind, pattern in _PATTERNS:
        if (kind == "email" and "@" not in text) or (kind not in ("email", "ip", "iban") and not digits) or (kind == "ip" and text.count(".") < 3):
            continue
        for m in pattern.finditer(text):
            value = m.group()
            if kind == "email":
                value = value.casefold()
            elif kind == "iban":
                value = value.replace(" ", "")
                if not 15 <= len(value) <= 34 or mod97(value) != 1:
                    continue
            elif kind == "card":
                if len(value) >= 13:
                    found += [(m.start() + a, m.start() + b, kind, re.sub(r"\D", "", value[a:b])) for a, b in cards(value)]
                continue
            elif kind == "phone":
                country = m.group(1) or m.group(2) or ""
                value = re.sub(r"\D", "", value[len(country) :])
            found.append((*m.span(), kind, value))
    found += names(text)
    found.sort(key=lambda x: (x[0], -x[1]))
    out, past = [], 0
    for x in found:
        if x[0] >= past:
            out.append(x)
            past = x[1]
    return out


def _numbers(key: bytes, kind: str, value: str, attempt: int):
    block = 0
    while True:
        for n in hashlib.blake2b(f"{kind}\0{value}\0{attempt}\0{block}".encode(), key=key, digest_size=64).digest():
            yield n
        block += 1


@lru_cache(4096)
def near_letters(c: str) -> str:
    """Letters of the same case in the same 32 code points."""
    first = ord(c) & ~31
    return "".join(x for x in map(chr, range(first, first + 32)) if x.isalpha() and x.islower() == c.islower() and x.isupper() == c.isupper() and x.casefold() == x.lower()) or c


def _swap(c: str, n: int) -> str:
    """A character of the same class and script."""
    if "0" <= c <= "9":
        return str(n % 10)
    low = c.lower()
    for kinds in SETS:
        for k in kinds:
            if low in k:
                new = k[n % len(k)]
                return new.upper() if c != low else new
    if c.isalpha():
        near = near_letters(c)
        return near[n % len(near)]
    return c


#: Rounds in which a listed given name is drawn from the list, and after which surrogates get longer.
LISTED, LONGER = 3, 4


def draw(kind: str, value: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of a canonical value, itself a valid value of its kind; later attempts make it longer."""
    if kind[6:] in GIVEN and attempt < LISTED:
        listed = sorted((n.casefold() for n in GIVEN[kind[6:]]), key=lambda n: hashlib.blake2b(n.encode(), key=key).digest())
        return listed[(listed.index(value) + 1 + attempt) % len(listed)]
    n = _numbers(key, kind, value, attempt)
    longer = max(0, attempt - LONGER + 1)  # where a format has too few free values
    if kind == "email":
        body, top = value.rsplit(".", 1)
        return "".join(chr(97 + next(n) % 26) for _ in range(longer)) + "".join(_swap(c, next(n)) for c in body) + "." + top
    if kind == "ip":
        ranges = {1: (0, 10), 2: (10, 100), 3: (100, 256)} if not longer else dict.fromkeys((1, 2, 3), (0, 256))
        more = "".join(f".{next(n) % 256}" for _ in range(max(0, longer - 8)))  # only when IPv4 has no free address left
        return ".".join(str(a + next(n) % (b - a)) for a, b in (ranges[len(x)] for x in value.split("."))) + more
    if kind == "iban":
        body = value[:2] + "00" + "".join(str(next(n) % 10) if c.isdigit() else chr(65 + next(n) % 26) for c in value[4:]) + "".join(str(next(n) % 10) for _ in range(longer))
        return body[:2] + f"{98 - mod97(body):02d}" + body[4:]
    if kind == "card":
        body = value[0] + "".join(str(next(n) % 10) for _ in range(len(value) - 2 + longer))
        return body + str(-luhn(body + "0") % 10)
    if kind in ("phone", "ssn"):
        return "".join(c if not c.isdigit() else str(1 + next(n) % 9) if i == 0 else str(next(n) % 10) for i, c in enumerate(value)) + "".join(str(next(n) % 10) for _ in range(longer))
    # Names: the last letter of given names and of Cyrillic surnames tells the gender.
    tail = value[-1:] if kind != "surname" or script(value) == "cyrillic" else ""
    stem = value[: len(value) - len(tail)]
    base = stem[-1:] if stem[-1:].isalpha() else value[-1:]
    return "".join(_swap(c, next(n)) for c in stem) + "".join(_swap(base, next(n)) for _ in range(longer)) + tail


def pour(found: str, kind: str, surrogate: str) -> str:
    """The surrogate in the format of the text found: its separators, country code and case."""
    if kind in ("card", "phone", "iban"):
        country = re.match(r"\+\d{1,3}(?=[ .-]?\(|[ .-]?\d)", found) if kind == "phone" else None
        head = ""
        if country:
            digits = sum(c.isdigit() for c in found)
            mine = min(digits, len(surrogate))
            head = found[: next(i for i in range(len(found) + 1) if sum(c.isdigit() for c in found[:i]) == digits - mine)]
        it = iter(surrogate)
        return head + "".join(next(it, "") if c.isalnum() else c for c in found[len(head) :]) + "".join(it)
    if kind == "email" or kind.startswith(("given_", "surname")):
        if len(found) == len(surrogate):
            return "".join(s.upper() if f.isupper() else s for f, s in zip(found, surrogate))
        if found.isupper():
            return surrogate.upper()
        if found[:1].isupper() and kind != "email":
            return surrogate[:1].upper() + surrogate[1:]
    return surrogate


def rewrite(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    """text with its spans (start, end, kind, surrogate), in order, replaced."""
    out, past = [], 0
    for a, b, kind, surrogate in spans:
        out += [text[past:a], pour(text[a:b], kind, surrogate)]
        past = b
    return "".join([*out, text[past:]])


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, value, surrogate of distinct entities, without collisions."""
    real = cut(entities.select("kind", "value").distinct())
    # Given names of all genders are one type: they are told apart by their spelling alone.
    kind = F.when(F.col("kind").startswith("given_"), F.lit("given")).otherwise(F.col("kind"))
    met = real.select(kind.alias("type"), F.col("value").alias("surrogate")).distinct().withColumn("real", F.lit(True))
    done, left, attempt = None, real, 0
    while True:
        new = F.arrow_udf(lambda k, v, a=attempt: pa.array([draw(x, y, key, a) for x, y in zip(k.to_pylist(), v.to_pylist())], pa.string()), "string")
        drawn = left.withColumn("surrogate", new("kind", "value")).withColumn("type", kind).withColumn("fresh", F.lit(True))
        both = drawn if done is None else drawn.unionByName(done.withColumn("type", kind).withColumn("fresh", F.lit(False)))
        first = both.groupBy("type", "surrogate").agg(F.min(F.struct("fresh", "kind", "value")).alias("first"))
        told = drawn.join(first, ["type", "surrogate"]).join(met, ["type", "surrogate"], "left")
        ok = F.col("real").isNull() & F.col("first.fresh") & (F.col("first.kind") == F.col("kind")) & (F.col("first.value") == F.col("value"))
        told = cut(told.select("kind", "value", "surrogate", ok.alias("ok")))
        good = told.where("ok").drop("ok")
        done = good if done is None else cut(done.unionByName(good))
        left = told.where("not ok").select("kind", "value")
        if left.isEmpty():
            return done
        attempt += 1


SPANS = "array<struct<start:int,end:int,kind:string,value:string>>"


def found_in(docs: DataFrame) -> DataFrame:
    """hash, key and spans of the distinct texts that have entities; the hash is 64 bits, the key a SHA-256 of the text."""

    def find(batches):
        for b in batches:
            rows = []
            for h, t in zip(b.column("hash").to_pylist(), b.column("text").to_pylist()):
                if spans := detect(t):
                    rows.append({"hash": h, "key": hashlib.sha256(t.encode()).hexdigest(), "spans": [dict(zip(("start", "end", "kind", "value"), x)) for x in spans]})
            span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())])
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("hash", pa.int64()), ("key", pa.string()), ("spans", pa.list_(span))]))

    texts = docs.where("text is not null").select(F.xxhash64("text").alias("hash"), "text")
    return cut(texts.mapInArrow(find, f"hash long, key string, spans {SPANS}").dropDuplicates(["key"]))


def replace(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """docs with their entities replaced by surrogates under a secret key, in text and n_chars; counts adds n_entities."""
    secret = hashlib.sha256(key.encode()).digest()
    found = found_in(docs)
    each = found.select("key", F.inline("spans"))
    told = each.join(surrogates(each, secret), ["kind", "value"])
    by_text = cut(told.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "surrogate"))).alias("spans")))

    bits = docs.sparkSession.sparkContext.broadcast(sieve(found.select(F.col("hash").alias("node"))))

    def passes(hashes: pa.Array) -> pa.Array:
        low = hashes.to_numpy() & (8 * len(bits.value) - 1)
        return pa.array((bits.value[low >> 3] >> (7 - (low & 7)).astype("uint8")) & 1 == 1)

    def put(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t if s is None else rewrite(t, [tuple(x.values()) for x in s]) for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    # The columns of docs are held in one, so that no name of theirs meets a name from here.
    flag = F.arrow_udf(passes, "boolean")(F.xxhash64("text"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), (F.col("text").isNotNull() & flag).alias("some"))
    mixed = rows.where("some").select("row", F.sha2(F.encode("row.text", "UTF-8"), 256).alias("key")).join(by_text, "key", "left")
    mixed = mixed.select("row", F.arrow_udf(put, "string")("row.text", "spans").alias("new"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n"))
    clean = rows.where("not some").select("row", F.col("row.text").alias("new"), F.lit(0).cast("long").alias("n"))

    def columns(changed: bool) -> list[Column]:
        out = []
        for c in docs.columns:
            value = F.col(f"row.`{c}`")
            if c == "text":
                value = F.col("new")
            elif c == "n_chars" and changed:
                value = F.when(F.col("n") > 0, F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(value)
            out.append(value.alias("n_entities_kept" if counts and c == "n_entities" else c))
        return [*out, *([F.col("n").alias("n_entities")] if counts else [])]

    return clean.select(*columns(False)).unionByName(mixed.select(*columns(True)))
