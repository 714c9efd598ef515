"""Personal data replaced by surrogates of the same kind.

Entities are found in each text by their form (addresses, numbers, keys) or by a cue (names after a
title or an introduction). Each distinct entity of the corpus gets one surrogate, drawn from a keyed
hash of its kind and its plain form, so mentions of one person or number stay the same wherever and
however they are written. A surrogate keeps what kind of thing the entity is: digits stay digits in
the same places, checksums stay right, addresses keep their shape, names keep gender, script and
case. A name is one entity whether a title, an introduction or a family name tells of it: whether it
is given or family, and of a man or a woman, is settled by the documents of the corpus that say so.
Numbers that fail the checksum of their kind (cards, IBANs) are no entities of it.

Distinct entities must stay distinct. So surrogates are compared over the whole corpus, with each
other and with all entities, names of every kind together, and those that meet are drawn again until
none do. Then they are joined
back to the documents that need them; documents without any candidate pass by untouched and are
not shuffled.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import free_name, saved, text_key

# Words that announce a secret, a person, or a name.
SECRET_WORDS = "password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key|private[_-]?key|credential"
TITLES_MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Sir", "Lord", "г-н", "господин")
TITLES_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Señorita", "Lady", "г-жа", "госпожа")
TITLES_OTHER = ("Dr", "Prof", "Professor", "Doctor", "Mx", "Rev")
INTRODUCTIONS = ("my name is", "My name is", "je m'appelle", "Je m'appelle", "ich heiße", "Ich heiße", "mein Name ist",
                 "Mein Name ist", "me llamo", "Me llamo", "mi nombre es", "Mi nombre es", "меня зовут", "Меня зовут")
# Letters that surrogate names are spelt with, by script: consonants, vowels, and the
# endings of given names for men, women and others, and of family names.
SPELLING = {
    "Latin": ("bdfgklmnprstv", "aeiou", ("o", "an", "er"), ("a", "ia", "ine"), ("is", "el"), ("son", "man", "ley", "ton")),
    "Cyrillic": ("бвгдзклмнпрст", "аеиоу", ("ий", "ан"), ("а", "ия"), ("ен",), ("ов", "ин")),
    "Greek": ("βγδζθκλμνπρστ", "αειου", ("ος", "ας"), ("η", "α"), ("ις",), ("ίδης", "άκης")),
    "Han": ("王李张刘陈杨黄赵吴周徐孙马朱胡林郭何高罗", "一", ("伟", "强", "军"), ("芳", "娜", "丽"), ("文",), ("",)),
    "Arabic": ("بتجدرسعفكلمنه", "اوي", ("د", "ر"), ("ة",), ("ن",), ("ي",)),
}
_NAME = r"\p{Lu}[\p{L}\p{M}'’-]*\p{L}|\p{Lo}{1,4}"
_TITLE = "|".join(regex.escape(t) for t in sorted((*TITLES_MALE, *TITLES_FEMALE, *TITLES_OTHER), key=len, reverse=True))
_INTRO = "|".join(regex.escape(t) for t in INTRODUCTIONS)
_PERSON = regex.compile(rf"(?<![\p{{L}}])(?:(?P<title>{_TITLE})\.?|(?:{_INTRO}))[ \t]+(?P<name>(?:{_NAME})(?:[ \t]+(?:{_NAME})){{0,2}})")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_SHORT_IPV6 = (rf"(?:{_GROUP}(?::{_GROUP}){{0,6}})?::(?:(?:{_GROUP}:){{0,5}}(?:{_OCTET}\.){{3}}{_OCTET}|{_GROUP}(?::{_GROUP}){{0,6}})?"
               rf"|(?:{_GROUP}:){{6}}(?:{_OCTET}\.){{3}}{_OCTET}")
# In the order of precedence where two overlap.
FORMS = [
    # A run of letters is entered at its start only, or where the address before it ended.
    ("email", regex.compile(r"(?:(?<![\p{L}\p{N}._%+-])|\G)[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++")),
    ("secret", regex.compile(rf"(?i)(?<![a-z])(?:{SECRET_WORDS})[\"']?\s{{0,3}}[:=]\s{{0,3}}[\"']?(?P<it>[A-Za-z0-9+/_.~-]{{8,}}={{0,2}})")),
    ("secret", regex.compile(r"(?<![A-Za-z0-9])(?P<it>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9-]{20,})")),
    ("iban", regex.compile(r"(?a)(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("mac", regex.compile(r"(?a)(?<![0-9A-Fa-f:-])(?:[0-9A-Fa-f]{2}([:-]))(?:[0-9A-Fa-f]{2}\1){4}[0-9A-Fa-f]{2}(?![0-9A-Fa-f:-])")),
    ("ipv6", regex.compile(r"(?a)(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")),
    ("ipv6", regex.compile(rf"(?a)(?<!\w)(?<![0-9A-Fa-f:]:)(?:{_SHORT_IPV6})(?!\w|:[0-9A-Fa-f:]|\.\d)")),
    ("ip", regex.compile(rf"(?a)(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)")),
    ("ssn", regex.compile(r"(?a)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", regex.compile(r"(?a)(?<![\d+.-])\d(?:[ -]?\d){12,18}(?!\d|[.-]\d)")),
    ("phone", regex.compile(r"(?a)(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{1,4}\)[ .-]?)?\d{2,5}(?:[ .-]?\d{2,5}){1,4}(?!\w|[.-]\d)")),
]
# No entity is found in a text without one of these. Spark's own engine looks for them in all texts, so
# each alternative begins with characters that are rare: a secret needs its colon or equals sign, a
# title its capital, and the introductions are searched for as they stand.
_CAPITALS = "".join(sorted({t[0] for t in (*TITLES_MALE, *TITLES_FEMALE, *TITLES_OTHER)}))
NEED = (rf"[@:=]|[0-9]{{2}}|[0-9][ .-][0-9]|[0-9A-Fa-f]{{2}}-|AKIA|ASIA|gh[pousr]_|sk-|(?=[{_CAPITALS}])(?:{_TITLE})")


def _script(text: str) -> str:
    for name in SPELLING:
        if regex.search(rf"\p{{{name}}}", text):
            return name
    return "Latin"


def plain(kind: str, text: str) -> str | None:
    """The form by which mentions of one entity are the same; None if it is none of its kind."""
    digits = "".join(c for c in text if c.isdigit())
    if kind == "phone":
        marked = text.startswith("+") or "(" in text
        if not (8 if marked else 10) <= len(digits) <= 15:
            return None
        return ("+" if text.startswith("+") else "") + digits
    if kind == "card":  # 2 to 6 are what the networks' numbers begin with
        return digits if digits[0] in "23456" and _luhn(digits) else None
    if kind == "ssn":
        return digits
    if kind == "iban":
        form = text.replace(" ", "")
        return form if _iban_ok(form) else None
    if kind == "ipv6":
        try:
            number = int(ipaddress.IPv6Address(text))
        except ValueError:
            return None
        return ":".join(f"{number >> k & 0xFFFF:x}" for k in range(112, -1, -16)) if number else None
    if kind in ("email", "mac") or kind.startswith(("given", "family")):
        return text.lower()
    return text


def entity_of(kind: str) -> str:
    """What surrogates are one to one in: the kind, but ``name`` for all kinds of names."""
    return "name" if kind.startswith(("given", "family")) else kind


def find(text: str | None) -> list[tuple[int, int, str, str]]:
    """Start, end, kind and plain form of every entity, in order, none overlapping another."""
    if not text:
        return []
    found: list[tuple[int, int, str, str]] = []
    starts: list[int] = []  # of what is taken, in order, and the ends
    ends: list[int] = []

    def take(a: int, b: int, kind: str) -> None:
        form = plain(kind, text[a:b])
        at = bisect.bisect_left(starts, b)
        if form and (at == 0 or ends[at - 1] <= a):
            starts.insert(at, a)
            ends.insert(at, b)
            found.append((a, b, kind, form))

    for kind, pattern in FORMS:
        for m in pattern.finditer(text):
            take(*m.span("it" if "it" in m.groupdict() else 0), kind)
    names: dict[str, str] = {}
    for m in _PERSON.finditer(text):
        title = m["title"]
        sex = "m" if title in TITLES_MALE else "f" if title in TITLES_FEMALE else "n"
        parts = list(regex.finditer(r"\S+", m["name"]))
        for k, part in enumerate(parts):
            last = k == len(parts) - 1 and (len(parts) > 1 or title is not None)
            word = part[0].strip("'’-")
            names.setdefault(word, "family" if last else f"given-{sex}")
    if names:  # every mention in the text, with and without the cue
        words = "|".join(regex.escape(w) for w in sorted(names, key=len, reverse=True))
        for m in regex.finditer(rf"(?<![\p{{L}}\p{{M}}])(?:{words})(?![\p{{L}}\p{{M}}])", text):
            take(m.start(), m.end(), names[m[0]])
    return sorted(found)


class _Draw:
    """Numbers from a keyed hash, as many as are asked for."""

    def __init__(self, key: bytes, *parts):
        self.key, self.text, self.block, self.pool = key, "\x1f".join(map(str, parts)), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, f"{self.block}\x1f{self.text}".encode(), hashlib.sha256).digest()
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return value % n

    def of(self, choices):
        return choices[self.below(len(choices))]

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits; hexadecimal stays so."""
        if regex.fullmatch(r"[0-9a-f]{8,}", text):
            return "".join(self.of("0123456789abcdef") for _ in text)
        return "".join(self.of("0123456789") if c.isdigit() else self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ") if c.isupper()
                       else self.of("abcdefghijklmnopqrstuvwxyz") if c.isalpha() else c for c in text)


def _luhn(digits: str) -> bool:
    total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits)))
    return total % 10 == 0


def _iban_ok(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def surrogate(key: bytes, kind: str, form: str, attempt: int = 0) -> str:
    """The plain form of an entity's stand-in."""
    draw = _Draw(key, kind, form, attempt)
    if kind == "email":
        local, _, domain = form.partition("@")
        labels = domain.split(".")
        host = [draw.like(x) for x in labels[:-2]]
        return f"{draw.like(local)}@{'.'.join([*host, 'example', draw.of(('com', 'org', 'net'))])}"
    if kind == "phone":
        plus, digits = form.startswith("+"), form.lstrip("+")
        keep = (1 if digits[0] in "17" else 2) if plus else 0
        rest = str(2 + draw.below(8)) + "".join(str(draw.below(10)) for _ in digits[keep + 1:])
        return ("+" if plus else "") + digits[:keep] + rest
    if kind == "ip":
        a, b, c, d = (int(x) for x in form.split("."))
        low = [draw.below(256) for _ in range(3)]
        if a in (10, 127):
            return f"{a}.{low[0]}.{low[1]}.{low[2]}"
        if (a, b) == (192, 168) or a == 172 and 16 <= b < 32:
            return f"{a}.{b}.{low[1]}.{low[2]}"
        return f"{draw.of([x for x in range(1, 224) if x not in (10, 127, 172, 192)])}.{low[0]}.{low[1]}.{low[2]}"
    if kind == "card":
        body = form[0] + "".join(str(draw.below(10)) for _ in form[2:])
        right = next(str(d) for d in range(10) if _luhn(body + str(d)))
        return body + (right if _luhn(form) else str((int(right) + 1 + draw.below(9)) % 10))
    if kind == "ssn":  # area numbers that are never given out
        return f"9{draw.below(10**8):08d}"
    if kind == "iban":
        body = draw.like(form[4:])
        checks = [f"{x:02d}" for x in range(2, 99) if _iban_ok(f"{form[:2]}{x:02d}{body}")]
        check = checks[0] if _iban_ok(form) and checks else draw.like(form[2:4])
        return form[:2] + check + body
    if kind == "mac":
        return form[0] + "2" + "".join(draw.of("0123456789abcdef") if c not in ":-" else c for c in form[2:])
    if kind == "ipv6":
        # Zero groups stay, so that it can be written as short; where that leaves too few, all are drawn.
        return ":".join(part if part == "0" and attempt < 8 else f"{0x1000 + draw.below(0xF000):x}" for part in form.split(":"))
    if kind.startswith(("given", "family")):
        return "".join(p if p in "-'’" else _name(draw, kind, p) for p in regex.split(r"([-'’])", form))
    return draw.like(form)


def _name(draw: _Draw, kind: str, form: str) -> str:
    if not form:
        return ""
    consonants, vowels, male, female, other, family = SPELLING[_script(form)]
    if _script(form) == "Han":
        return "".join(draw.of(consonants) for _ in form[:-1]) + (draw.of(consonants) if kind == "family" else
                                                                 draw.of({"given-m": male, "given-f": female}.get(kind, other)))
    stem = "".join(draw.of(consonants) + draw.of(vowels) for _ in range(1 + min(3, len(form) // 4) + draw.below(2))) + draw.of(consonants)
    ending = draw.of({"given-m": male, "given-f": female, "family": family}.get(kind, other))
    if kind == "family" and _script(form) == "Cyrillic" and form.endswith(("а", "я")):
        ending += "а"
    return stem + ending


def render(kind: str, mention: str, stand_in: str) -> str:
    """A stand-in written the way the mention is: separators, spaces and case."""
    if kind in ("phone", "card", "ssn", "iban", "mac"):
        source = iter(c for c in stand_in if c.isalnum())
        out = "".join(next(source, "") if c.isalnum() else c for c in mention)
        return out.upper() if kind == "mac" and mention.isupper() else out
    if kind == "ipv6":
        full = all(len(g) == 4 for g in mention.split(":"))
        out = ipaddress.IPv6Address(stand_in)
        out = out.compressed if "::" in mention else out.exploded if full else stand_in
        return out.upper() if mention.isupper() else out
    if kind == "email" or kind.startswith(("given", "family")):
        if mention.isupper():
            return stand_in.upper()
        if mention[:1].isupper():
            return "".join(p[:1].upper() + p[1:] for p in regex.split(r"(?<=[-'’])", stand_in))
    return stand_in


def _needed(text: str = "text") -> Column:
    found = F.col(text).rlike(NEED)
    for words in INTRODUCTIONS:
        found = found | F.col(text).contains(words)
    return F.coalesce(found, F.lit(False))


def _entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for doc_id, key, text in zip(*(batch.column(i) for i in range(3))):
            for kind, form in dict.fromkeys((k, f) for _, _, k, f in find(text.as_py())):
                for c, v in zip(out, (doc_id.as_py(), key.as_py(), kind, form)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()),
                                          pa.array(out[3], pa.string())], names=["doc_id", "key", "kind", "form"])


def _drawn(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, forms, attempts = (batch.column(i).to_pylist() for i in range(3))
            found = [surrogate(key, k, f, a) for k, f, a in zip(kinds, forms, attempts)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             names=["kind", "form", "attempt", "stand_in"])
    return run


def _entity() -> Column:
    """``entity_of`` the column ``kind``."""
    kind = F.col("kind")
    return F.when(kind.startswith("given") | kind.startswith("family"), "name").otherwise(kind)


def _resolved(entities: DataFrame) -> DataFrame:
    """One row (kind, form) for each entity. A name that more documents have as a family name than as
    a given one is a family name; a given name is a man's or a woman's if more documents say so than
    say the other, by title, and else neither."""
    def said(kind: str) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1))
    counted = entities.groupBy(_entity().alias("entity"), "form").agg(
        said("given-m").alias("m"), said("given-f").alias("f"), said("given-n").alias("n"), said("family").alias("family"))
    kind = (F.when(F.col("entity") != "name", F.col("entity"))
            .when(F.col("family") > F.col("m") + F.col("f") + F.col("n"), "family")
            .when(F.col("m") > F.col("f"), "given-m").when(F.col("f") > F.col("m"), "given-f").otherwise("given-n"))
    return counted.select(kind.alias("kind"), "form")


def stand_ins(entities: DataFrame, key: bytes) -> DataFrame:
    """(entity, form) -> stand_in, one to one for each entity kind (``entity_of``) and never the form
    of an entity of that kind. ``entities`` has a row (kind, form) for each document with the entity."""
    ddl = "kind string, form string, attempt int, stand_in string"

    def draw(forms: DataFrame) -> DataFrame:
        return forms.mapInArrow(_drawn(key), ddl).withColumn("entity", _entity())

    same = ["entity", "form"]
    drawn = saved(draw(_resolved(entities).withColumn("attempt", F.lit(0))), "stand-ins")
    while True:
        first = drawn.groupBy("entity", "stand_in").agg(F.min(F.struct("attempt", "form")).alias("first"), F.count("*").alias("n"))
        shared = drawn.join(first.where("n > 1"), ["entity", "stand_in"]).where("form <> first.form").select(*same)
        real = drawn.join(drawn.select("entity", F.col("form").alias("stand_in")), ["entity", "stand_in"], "left_semi").select(*same)
        again = saved(shared.unionByName(real).distinct(), "collisions")
        if again.isEmpty():
            return drawn.select(*same, "stand_in")
        redrawn = draw(drawn.join(again, same).select("kind", "form", (F.col("attempt") + 1).alias("attempt")))
        drawn = saved(drawn.join(again, same, "left_anti").unionByName(redrawn), "stand-ins")


def _replace(text: int, known: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for value, given in zip(batch.column(text), batch.column(known)):
                value = value.as_py()
                table = {(g["entity"], g["form"]): g["stand_in"] for g in given.as_py() or ()}
                parts, at, n = [], 0, 0
                for a, b, kind, form in find(value) if table else ():
                    parts += [value[at:a], render(kind, value[a:b], table[entity_of(kind), form])]
                    at, n = b, n + 1
                texts.append("".join([*parts, value[at:]]) if n else value)
                counts.append(n)
            columns, names = list(batch.columns), list(batch.schema.names)
            columns[text], columns[known] = pa.array(texts, pa.string()), pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def pseudonymize(docs: DataFrame, key: bytes, count_col: str = "n_entities") -> DataFrame:
    """The rows and columns given, with the entities of ``text`` replaced, and how many there were.

    ``key`` decides the surrogates; the same key and corpus give the same texts. A null or empty text
    has no entities. Rows that repeat an id, a text or both are treated alike. A column that has the
    name of the count is replaced; others are carried along. An empty table gives an empty result.
    """
    docs = docs.drop(count_col)
    mark, ids, keys = (free_name(docs, n) for n in ("text_hash", "entity_id", "entity_hash"))
    some = docs.where(_needed())
    entities = saved(some.select("doc_id", text_key().alias("key"), "text")
                     .mapInArrow(_entities, "doc_id long, key long, kind string, form string"), "entities")
    known = (entities.withColumn("entity", _entity()).join(stand_ins(entities, key), ["entity", "form"]).groupBy("doc_id", "key")
             .agg(F.collect_set(F.struct("entity", "form", "stand_in")).alias(count_col))
             .withColumnsRenamed({"doc_id": ids, "key": keys}))
    marked = some.withColumn(mark, text_key()).join(
        known, F.col("doc_id").eqNullSafe(F.col(ids)) & (F.col(mark) == F.col(keys)), "left").select(*docs.columns, count_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    replaced = marked.mapInArrow(_replace(docs.columns.index("text"), len(docs.columns)), f"{schema}, `{count_col}` long")
    return replaced.unionByName(docs.where(~_needed()).withColumn(count_col, F.lit(0).cast("long")))
