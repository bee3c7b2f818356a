"""Operator 6: replace personal data by keyed surrogates of the same type and form.

Found in the whole text: e-mail addresses, telephone numbers, card numbers, IPv4 and full IPv6 addresses,
account numbers (IBAN with valid check digits), social security numbers, quoted secrets after
``token``/``key``/``secret``/``password``, names after a form of address (initials, hyphens, apostrophes
and inner capitals included, up to three parts), and the parts of such a name wherever else they stand in
the same text. Every entity is reduced to its canonical value (lower case, digits without separators),
that value is replaced by a keyed permutation of all values of its form, and the surrogate is written in
the original's case and separators. So

* the same entity gets the same surrogate in every document (coreference), however it is written;
* two entities of a type never share a surrogate (a permutation has no collisions), and none keeps its value;
* a surrogate has the original's type, script and character classes, and its length but for listed names; a
  character of another script or with an accent becomes one of its own Unicode block and case; card and
  account numbers keep the validity of their check digits, octets stay octets. A name of the lists becomes
  one of the same list, that is of the same script and gender; any other name becomes letters that are in
  no list.

The permutation is a Feistel network over the form's mixed-radix numbers, walked until it lands inside
them. It needs no table of entities, hence no join and no hot entity. ``collisions`` checks the
property on a whole corpus: it counts, per type, entities that share a surrogate; ``replace_checked``
ends with an error if there are any.

The key is the caller's, else the session's ``spark.reshift.surrogates.key``. Without either a public one
is used, with a warning: whoever has the key can undo the replacement.

Defined cases: a null text stays null, an empty text empty; texts without an entity come back as they
are; repeated rows are rewritten alike; an empty table gives an empty result; other columns pass.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import logging
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reshift.llm.common import free_name, shared_table

log = logging.getLogger(__name__)

DEFAULT_KEY = "reshift-surrogates"
KEY_SETTING = "spark.reshift.surrogates.key"
FEISTEL_ROUNDS = 8

# Forms of address.
MALE_TITLES = ("Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "г-н")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа")
OTHER_TITLES = ("Dr", "Prof")

# Given names by script and gender, and family names by script.
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl",
                     "Leon", "Marco", "Noel", "Oscar", "Paul", "Quentin", "Robert", "Simon", "Thomas", "Victor"),
    ("latin", "f"): ("Anna", "Bianca", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Ines", "Julia", "Karin",
                     "Laura", "Maria", "Nina", "Olga", "Paula", "Rosa", "Sara", "Teresa", "Vera", "Wanda"),
    ("cyrillic", "m"): ("Алексей", "Борис", "Виктор", "Дмитрий", "Иван", "Максим", "Николай", "Павел", "Сергей"),
    ("cyrillic", "f"): ("Анна", "Вера", "Галина", "Елена", "Ирина", "Мария", "Наталья", "Ольга", "Татьяна"),
}

_TITLES = "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
_SECRETS = "token|secret|password|api[_-]?key|key"
_UPPER = "A-ZÀ-ÖØ-ÞА-ЯЁ"
_PART = rf"[{_UPPER}](?:[^\W\d_]|['’-](?=[^\W\d_]))+"
_NAME = rf"(?:[{_UPPER}]\.?[ \t]+){{0,2}}{_PART}(?:[ \t]+{_PART}){{0,2}}"
LEAST_MENTION = 3  # letters of a name's part that is looked for without its title
PATTERN = re.compile(
    r"(?P<email>[\w.+-]+@[\w-]+(?:\.[\w-]+)+)"
    rf"|(?P<secret>(?i:{_SECRETS})\s*[=:]\s*[\"'](?P<value>[A-Za-z0-9_+/=-]{{12,}})[\"'])"
    r"|(?P<phone>(?<![\w.+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?![\w])"
    r"|(?<![\w.+])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.+-])\d{3}-\d{3}-\d{4}(?![\w-]))"
    r"|(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\w))"
    r"|(?P<ip6>(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:]))"
    r"|(?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))"
    r"|(?P<card>(?<![\w.])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?!\w))"
    rf"|(?P<title>\b(?:{_TITLES})\b\.?[ \t]+)(?P<name>{_NAME})"
)

# A text that matches none of this (a Java pattern) holds nothing that PATTERN finds: every alternative of
# PATTERN needs a digit of any script, an @, a form of address, the word before a secret or eight groups of
# hexadecimal letters.
TRIGGER = rf"[\p{{Nd}}@]|{_TITLES}|(?iu:{_SECRETS})|(?:[A-Fa-f]{{1,4}}:){{7}}"

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
_GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
_ALPHABETS = ["0123456789", _LOWER, _CYRILLIC, _GREEK]
_CLASS = {ch: a for a in _ALPHABETS for ch in a}
_MARKS = "+/=_-"  # what a secret may hold besides letters and digits
LEAST_LETTERS = 8  # of an alphabet made from a Unicode block


def _letter(ch: str, cased: bool) -> bool:
    """A lower-case letter that capitals bring back, or a letter without case."""
    if not ch.isalpha() or ch.lower() != ch:
        return False
    return (len(ch.upper()) == 1 and ch.upper().lower() == ch) if cased else ch.upper() == ch


@functools.lru_cache(maxsize=4096)
def alphabet_of(ch: str) -> str:
    """What a character may become: letters of its alphabet or Unicode block and case, digits of its script; else ''."""
    if ch in _CLASS:
        return _CLASS[ch]
    if ch.isdecimal():
        zero = ord(ch) - int(ch)
        return "".join(chr(zero + i) for i in range(10))
    cased = ch.upper() != ch
    if not _letter(ch, cased):
        return ""
    size = 64
    while size <= 0x10000:
        first = ord(ch) // size * size
        block = "".join(c for c in map(chr, range(first, first + size)) if c not in _CLASS and _letter(c, cased))
        if len(block) >= LEAST_LETTERS:
            return block
        size *= 2
    return ""


def lowered(text: str) -> str:
    """Lower case, character by character, so that places stay."""
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def cased_like(original: str, new: str) -> str:
    return "".join(n.upper() if o != o.lower() and len(n.upper()) == 1 else n for o, n in zip(original, new, strict=True))


def iban_check(country: str, account: str) -> str:
    """The two check digits of an account number."""
    number = "".join(str(int(c, 36)) for c in account.upper() + country.upper() + "00")
    return f"{98 - int(number) % 97:02d}"


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` plus itself a valid card number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return -total % 10


def valid_iban(text: str) -> bool:
    value = text.replace(" ", "")
    return 15 <= len(value) <= 34 and value[2:4] == iban_check(value[:2], value[4:])


_LETTERS = re.compile(r"[^\W\d_]+")
# every listed name in lower case, with its list
LISTED = {name.lower(): tuple(n.lower() for n in names) for names in GIVEN.values() for name in names}


class Surrogates:
    """Keyed replacements; ``replace(kind, entity)`` keeps the entity's form."""

    def __init__(self, key: str):
        self.key = key.encode()
        self.known: dict[tuple[str, str], str] = {}
        self.orders: dict[tuple[str, ...], list[str]] = {}

    def _digest(self, *parts: object) -> int:
        said = "\x1f".join(map(str, parts)).encode()
        return int.from_bytes(hmac.new(self.key, said, hashlib.sha256).digest(), "big")

    def permute(self, form: str, x: int, size: int) -> int:
        """A permutation of ``range(size)`` chosen by the key and the form, without ``x`` itself."""
        if size < 2:
            return x
        half = max(1, (size.bit_length() + 1) // 2)
        mask = (1 << half) - 1

        def once(v: int) -> int:
            left, right = v >> half, v & mask
            for turn in range(FEISTEL_ROUNDS):
                left, right = right, left ^ (self._digest(form, turn, right) & mask)
            return (left << half) | right

        def walk(v: int, step) -> int:
            v = step(v)
            while v >= size:
                v = step(v)
            return v

        def back(v: int) -> int:
            left, right = v >> half, v & mask
            for turn in reversed(range(FEISTEL_ROUNDS)):
                left, right = right ^ (self._digest(form, turn, left) & mask), left
            return (left << half) | right

        # conjugate "plus one" with the network: one cycle over all values, so no value maps to itself
        return walk((walk(x, once) + 1) % size, back)

    def scramble(self, kind: str, value: str) -> str:
        """Letters become letters of their alphabet, digits digits; other characters stay."""
        places = [(i, alphabet_of(ch)) for i, ch in enumerate(value) if alphabet_of(ch)]
        if not places:  # nothing but marks: they are what there is to permute
            kind, places = kind + "-marks", [(i, _MARKS) for i, ch in enumerate(value) if ch in _MARKS]
        free = dict(places)
        number, size = 0, 1
        for i, alphabet in places:
            number = number * len(alphabet) + alphabet.index(value[i])
            size *= len(alphabet)
        form = kind + ":" + "".join(free[i][0] if i in free else ch for i, ch in enumerate(value))
        number = self.permute(form, number, size)
        out = list(value)
        for i, alphabet in reversed(places):
            number, digit = divmod(number, len(alphabet))
            out[i] = alphabet[digit]
        return "".join(out)

    def _email(self, value: str) -> str:
        name, host = value.rsplit("@", 1)
        host, top = host.rsplit(".", 1)
        return self.scramble("email", f"{name}@{host}") + "." + top

    def _digits(self, kind: str, value: str) -> str:
        if kind == "card":
            body, last = value[:-1], int(value[-1])
            new = self.scramble("card", body)
            return new + str((last - luhn_digit(body) + luhn_digit(new)) % 10)
        return self.scramble(kind, value)

    def _ip(self, value: str) -> str:
        octets = [int(o) for o in value.split(".")]
        if max(octets) > 255:
            return self.scramble("ip-like", value)
        number = int.from_bytes(bytes(octets), "big")
        return ".".join(map(str, self.permute("ip", number, 1 << 32).to_bytes(4, "big")))

    def _ip6(self, value: str) -> str:
        groups = value.split(":")
        number = int("".join(g.zfill(4) for g in groups), 16)
        text = format(self.permute("ip6", number, 1 << 128), "032x")
        return ":".join(text[i:i + 4] for i in range(0, 32, 4))

    def _iban(self, value: str) -> str:
        country, account = value[:2], value[4:]
        new = self.scramble("iban-" + country, account)
        return country + iban_check(country, new) + new

    def _next_listed(self, name: str) -> str:
        """The next name in the key's order of the list."""
        names = LISTED[name]
        if names not in self.orders:
            self.orders[names] = sorted(names, key=lambda n: self._digest("listed", n))
        order = self.orders[names]
        return order[(order.index(name) + 1) % len(order)]

    def _part(self, part: str) -> str:
        """A part of a name (letters only): the next one of its list, or letters that are in no list."""
        plain = lowered(part)
        if plain in LISTED:
            new = self._next_listed(plain)
            return new.upper() if part.isupper() and len(part) > 1 else new.capitalize() if part[0].isupper() else new
        new = self.scramble("name", plain)
        while new in LISTED:  # walked on: still a permutation of the names that no list has
            new = self.scramble("name", new)
        return cased_like(part, new)

    def replace(self, kind: str, entity: str) -> str:
        """The surrogate of an entity, in the entity's case and separators."""
        if kind == "name":
            return _LETTERS.sub(lambda m: self._part(m[0]), entity)
        if kind in ("phone", "card", "ssn"):
            canon = "".join(str(int(d)) for d in re.findall(r"\d", entity))
            prefix = ""
            if kind == "phone":
                if entity.startswith("+"):
                    prefix = canon[:max(len(canon) - 10, 1)]
                canon = canon[len(prefix):]
        else:
            canon, prefix = (entity if kind == "secret" else lowered(entity.replace(" ", ""))), ""
            if kind == "ip6":
                canon = ":".join(g.zfill(4) for g in canon.split(":"))
        new = self.known.get((kind, canon))
        if new is None:
            if kind == "email":
                new = self._email(canon)
            elif kind == "ip":
                new = self._ip(canon)
            elif kind == "ip6":
                new = self._ip6(canon)
            elif kind == "iban":
                new = self._iban(canon)
            elif kind == "secret":
                new = self._secret(canon)
            else:
                new = self._digits(kind, canon)
            self.known[kind, canon] = new
        if kind in ("phone", "card", "ssn"):
            fill = iter(prefix + new)
            return re.sub(r"\d", lambda m: chr(ord(m[0]) - int(m[0]) + int(next(fill))), entity)  # in its own script
        if kind == "email":
            return cased_like(entity, new)
        if kind == "iban":
            fill = iter(new.upper())
            return "".join(" " if c == " " else next(fill) for c in entity)
        return new

    def _secret(self, value: str) -> str:
        """Hexadecimal stays hexadecimal; in other secrets each character keeps its class and case."""
        for digits in ("0123456789abcdef", "0123456789ABCDEF"):
            if all(ch in digits for ch in value):
                number = self.permute(f"hex-{digits[-1]}-{len(value)}", int(value, 16), 16 ** len(value))
                text = format(number, f"0{len(value)}x")
                return text.upper() if digits[-1] == "F" else text
        upper = "".join("1" if ch.isupper() else "0" for ch in value)
        new = self.scramble("secret" + upper, lowered(value))
        return "".join(n.upper() if u == "1" else n for n, u in zip(new, upper))

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and ``(type, entity, surrogate)`` in the order found."""
        matches = [m for m in PATTERN.finditer(text) if not m["iban"] or valid_iban(m["iban"])]
        names = [m["name"] for m in matches if m["title"]]
        parts = {p for n in names for p in (*_LETTERS.findall(n), *n.split()) if len(p) >= LEAST_MENTION}
        mention = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, parts), key=len, reverse=True))})(?!\w)") if parts else None
        found: list[tuple[str, str, str]] = []
        out: list[str] = []

        def put(kind: str, entity: str) -> str:
            new = self.replace(kind, entity)
            found.append((kind, entity, new))
            return new

        def between(start: int, end: int) -> None:
            piece = text[start:end]
            out.append(mention.sub(lambda m: put("name", m[0]), piece) if mention else piece)

        at = 0
        for m in matches:
            between(at, m.start())
            if m["title"]:
                out += [m["title"], put("name", m["name"])]
            elif m["secret"]:
                out += [text[m.start():m.start("value")], put("secret", m["value"]), text[m.end("value"):m.end()]]
            else:
                out.append(put(next(k for k in ("email", "phone", "ip", "ip6", "ssn", "iban", "card") if m[k]), m[0]))
            at = m.end()
        between(at, len(text))
        return "".join(out), found


REWRITTEN = "text string, entities array<struct<type:string,entity:string,surrogate:string>>"


def key_of(docs: DataFrame, key: str | None) -> str:
    """The caller's key, else the session's, else the public one."""
    key = key or docs.sparkSession.conf.get(KEY_SETTING, None)
    if not key:
        log.warning("no key given and %s is unset: surrogates are made with a public key", KEY_SETTING)
    return key or DEFAULT_KEY


def rewritten(text: Column, key: str) -> Column:
    """Struct of the rewritten text and its entities; null for texts without a trigger."""
    @F.pandas_udf(REWRITTEN)
    def run(texts: pd.Series) -> pd.DataFrame:
        names = Surrogates(key)
        rows = [names.rewrite(t) if t is not None else (None, []) for t in texts]
        fields = ("type", "entity", "surrogate")
        return pd.DataFrame({"text": [r[0] for r in rows],
                             "entities": [[dict(zip(fields, e)) for e in r[1]] for r in rows]},
                            columns=["text", "entities"])

    return run(F.when(text.rlike(TRIGGER), text))


def replace_entities(docs: DataFrame, key: str | None = None, into: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``; ``into`` names a column for the entities replaced."""
    name = free_name(docs, "rewritten_text")
    out = docs.withColumn(name, rewritten(F.col("text"), key_of(docs, key)))
    if into:
        out = out.withColumn(into, F.coalesce(F.col(f"{name}.entities"), F.array().cast(
            "array<struct<type:string,entity:string,surrogate:string>>")))
    return out.withColumn("text", F.coalesce(F.col(f"{name}.text"), F.col("text"))).drop(name)


class SharedSurrogate(RuntimeError):
    """Two entities have one surrogate, or one entity has two."""


def collisions(replaced: DataFrame, column: str = "entities") -> DataFrame:
    """Per type: entities, surrogates, surrogates that more than one entity shares, and entities with more than one.

    Entities are compared as they are read: without case, numbers without separators. A hot entity is
    counted before the shuffle.
    """
    def canon(field: str) -> Column:
        value = F.col(f"e.{field}")
        digits = F.regexp_replace(value, r"\D", "")
        return (F.when(F.col("e.type").isin("phone", "card", "ssn") & (digits != ""), digits)
                .when(F.col("e.type") == "secret", value).otherwise(F.lower(F.replace(value, F.lit(" "), F.lit("")))))

    # names are compared part by part: that is what has a surrogate
    parts = F.arrays_zip(*[F.regexp_extract_all(F.lower(f"e.{c}"), F.lit(r"\p{L}+"), F.lit(0)).alias(c)
                           for c in ("entity", "surrogate")])
    whole = F.array(F.struct(canon("entity").alias("entity"), canon("surrogate").alias("surrogate")))
    pairs = replaced.select(F.explode(column).alias("e")).select(
        "e.type", F.explode(F.when(F.col("e.type") == "name", parts).otherwise(whole)).alias("p"))
    pairs = shared_table(pairs.select("type", "p.*").distinct())  # read twice, found once
    shared = pairs.groupBy("type", "surrogate").agg(F.count("*").alias("n"))
    split = pairs.groupBy("type", "entity").agg(F.count("*").alias("n")).groupBy("type").agg(
        F.count_if(F.col("n") > 1).alias("split"))
    return (shared.groupBy("type").agg(F.sum("n").alias("entities"), F.count("*").alias("surrogates"),
                                       F.sum((F.col("n") > 1).cast("long")).alias("shared")).join(split, "type"))


def replace_checked(docs: DataFrame, key: str | None = None, into: str = "entities") -> DataFrame:
    """``replace_entities``, after all entities of ``docs`` have been checked for collisions."""
    out = replace_entities(docs, key, into)
    for r in collisions(out.select(into), into).collect():  # a row a type
        if r["shared"] or r["split"]:
            raise SharedSurrogate(f"{r['type']}: {r['shared']} surrogates of several entities, {r['split']} entities with several")
    return out
