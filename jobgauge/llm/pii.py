"""Personal data replaced by keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobgauge.llm.words import text_blocks
from jobgauge.sources.scratch import written

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}")
IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w)", re.ASCII)
SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.ASCII)
CARD = re.compile(r"(?<![\w.+-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])", re.ASCII)
PHONE = re.compile(r"(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}(?![\w-])", re.ASCII)
PATTERNS = (("email", EMAIL), ("ip", IP), ("ssn", SSN), ("card", CARD), ("phone", PHONE))

#: Titles in front of a name, by script and gender ("x" tells neither).
TITLES = {
    ("latin", "m"): ("Mr.", "Mr", "Herr", "Señor", "Sr.", "Monsieur"),
    ("latin", "f"): ("Mrs.", "Mrs", "Ms.", "Ms", "Frau", "Señora", "Sra.", "Madame", "Mme"),
    ("latin", "x"): ("Dr.", "Prof."),
    ("cyrillic", "m"): ("Господин", "господин", "г-н"),
    ("cyrillic", "f"): ("Госпожа", "госпожа", "г-жа"),
}
_NAME = {
    "latin": r"[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+(?:-[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+)?",
    "cyrillic": r"[А-ЯЁ][а-яё]+(?:-[А-ЯЁ][а-яё]+)?",
}
_TITLED = {
    key: re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, titles))})\x20({_NAME[key[0]]}(?:\x20{_NAME[key[0]]}){{0,2}})")
    for key, titles in TITLES.items()
}
#: First names of the surrogates by script and gender, and the syllables of their last names.
FIRST_NAMES = {
    ("latin", "m"): ("Adam", "Bruno", "David", "Erik", "Felix", "Hugo", "Jonas", "Leon", "Martin", "Oscar", "Paul", "Simon"),
    ("latin", "f"): ("Anna", "Clara", "Diana", "Elena", "Flora", "Ida", "Julia", "Laura", "Maria", "Nina", "Sara", "Vera"),
    ("latin", "x"): ("Alex", "Chris", "Dominique", "Kim", "Nicola", "Robin", "Sam", "Toni"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Денис", "Иван", "Олег", "Павел", "Фёдор"),
    ("cyrillic", "f"): ("Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Нина", "Ольга"),
}
SYLLABLES = {
    "latin": ("ba", "den", "fel", "gor", "hal", "kin", "lam", "mar", "nor", "pel", "ran", "sol", "tev", "vin", "wes", "zan"),
    "cyrillic": ("ба", "ве", "го", "да", "жу", "зи", "ка", "ла", "ме", "но", "пе", "ра", "со", "ту", "ха", "чи"),
}
_LAST_END = {("cyrillic", "m"): "ов", ("cyrillic", "f"): "ова"}
_HINTS = tuple(sorted({title.split()[0] for titles in TITLES.values() for title in titles}))


@dataclass(frozen=True)
class Entity:
    """A place in a text, and the normal form `value` that equal entities share."""

    start: int
    end: int
    kind: str
    value: str


def normal_form(kind: str, text: str) -> str:
    if kind == "email":
        return text.lower()
    return text if kind == "ip" else re.sub(r"\D", "", text, flags=re.ASCII)


def find_entities(text: str) -> list[Entity]:
    """All entities by start, without overlap; earlier kinds win. Later mentions of a titled name belong to it."""
    taken: list[Entity] = []

    def add(start: int, end: int, kind: str, value: str) -> None:
        at = bisect_left(taken, start, key=lambda e: e.start)
        if (at == 0 or taken[at - 1].end <= start) and (at == len(taken) or end <= taken[at].start):
            taken.insert(at, Entity(start, end, kind, value))

    for kind, pattern in PATTERNS:
        for m in pattern.finditer(text):
            add(m.start(), m.end(), kind, normal_form(kind, m[0]))
    mentions: dict[str, str] = {}
    for (script, gender), pattern in _TITLED.items():
        for m in pattern.finditer(text):
            mentions.setdefault(m[1], f"{script}:{gender}:{m[1].lower()}")
    for name in sorted(mentions, key=len, reverse=True):
        last = name.split()[-1]
        # A last name alone stands for the longest full name of the document that ends in it.
        mentions.setdefault(last, mentions[name])
        if last != name and mentions[last].split(":")[2] == last.lower():
            mentions[last] = mentions[name]
    if mentions:
        names = "|".join(re.escape(name) for name in sorted(mentions, key=len, reverse=True))
        for m in re.finditer(rf"(?<!\w)(?:{names})(?!\w)", text):
            add(m.start(), m.end(), "person", mentions[m[0]])
    return taken


#: Attempts after which the space of a format counts as full, and its surrogates may leave it: see `surrogate`.
WIDEN = 4


class _Draw:
    """A stream of numbers fixed by the key and the entity."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int) -> None:
        self.key, self.label, self.block, self.bytes = key, f"{kind}\0{value}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.bytes) < 4:
            self.bytes += hmac.new(self.key, self.label + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        number, self.bytes = int.from_bytes(self.bytes[:4], "big"), self.bytes[4:]
        return number % n


def surname_of(person: str) -> str:
    """The normal form of the surname, script and last word, of the normal form of a person."""
    return f"{person.split(':', 1)[0]}:{person.split(':', 2)[2].split()[-1]}"


def surrogate(key: bytes, kind: str, value: str, attempt: int = 0) -> str:
    """The replacement of a normal form, a normal form of the same kind; each attempt gives another one.

    That of a surname is its script and stem. That of a person is what tells full names apart: script, drawn given names
    and, as real and drawn surnames go one to one, the real surname. A surname alone is a person of its own.

    Names get longer with every attempt. The other kinds keep their form for `WIDEN` attempts. Then addresses of private
    networks leave these, e-mails get one more letter and numbers one more digit an attempt, and after as many attempts
    again addresses become ones of the IPv6 range for documents. So draws end however many entities fill a form.
    """
    more = max(0, attempt - WIDEN + 1)
    draw = _Draw(key, kind, value, attempt)
    if kind == "surname":
        script = value.partition(":")[0]
        return f"{script}:{''.join(SYLLABLES[script][draw.below(16)] for _ in range(3 + attempt))}"
    if kind == "person":
        script, surname = surname_of(value).split(":")
        given = _given_names(draw, value, attempt)
        return f"{script}::{' '.join([*given, surname])}" if given else f"::{value}"
    if kind == "ip":
        parts = value.split(".")
        if attempt >= 2 * WIDEN:
            return "2001:db8::" + ":".join(f"{draw.below(1 << 16):x}" for _ in range(5))
        kept = 0 if more else 2 if value.startswith("192.168.") else 1 if parts[0] in ("10", "127") else 0
        drawn = [str(1 + draw.below(223)) if i == 0 else str(draw.below(256)) for i in range(4)]
        return ".".join(parts[:kept] + drawn[kept:])
    if kind == "email":
        local, _, domain = value.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{_redrawn(local + 'x' * more, draw)}@{_redrawn(host, draw)}.{top}"
    digits = _redrawn(value + "0" * more, draw)
    if kind == "card" and _luhn(value) == 0:
        digits = next(digits[:-1] + str(d) for d in range(10) if _luhn(digits[:-1] + str(d)) == 0)
    return digits


def _given_names(draw: _Draw, person: str, attempt: int) -> list[str]:
    """A name for each given name; later attempts join two, and then add syllables to have ever more of them."""
    script, gender, name = person.split(":", 2)
    first, given = FIRST_NAMES[script, gender], []
    for _ in name.split()[1:]:
        parts = [first[draw.below(len(first))].lower() for _ in range(1 + (attempt > 0))]
        given.append("-".join(parts) + "".join(SYLLABLES[script][draw.below(16)] for _ in range(attempt - 1)))
    return given


def person_surrogate(key: bytes, person: str, attempt: int = 0, surname_attempt: int = 0) -> str:
    """The drawn full name of a person as a normal form, from the attempts of the person and of the surname."""
    script, gender, _ = person.split(":", 2)
    stem = surrogate(key, "surname", surname_of(person), surname_attempt).partition(":")[2]
    given = _given_names(_Draw(key, "person", person, attempt), person, attempt)
    return f"{script}:{gender}:{' '.join([*given, stem + _LAST_END.get((script, gender), '')])}"


def _redrawn(text: str, draw: _Draw) -> str:
    letters = "abcdefghijklmnopqrstuvwxyz"
    return "".join(
        str(draw.below(10)) if c.isdigit() else letters[draw.below(26)] if c.isalpha() else c for c in text
    )


def _luhn(digits: str) -> int:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def render(entity: Entity, found: str, replacement: str) -> str:
    """The replacement in the format of the text found: its separators, its case, the same parts of a name."""
    if entity.kind == "person":
        words = replacement.split(":", 2)[2].split()
        count = len(found.split())
        styled = [w.upper() if f.isupper() else w.title() for w, f in zip(words[-count:], found.split(), strict=False)]
        return " ".join(styled)
    if entity.kind in ("ssn", "card", "phone"):
        digits = iter(replacement)
        return "".join(next(digits) if c.isdigit() else c for c in found) + "".join(digits)
    if entity.kind == "email" and len(found) == len(replacement):
        return "".join(r.upper() if f.isupper() else r for r, f in zip(replacement, found, strict=True))
    return replacement


def marked_rows(column: pa.Array) -> list[int]:
    """The rows whose text may hold an entity, found on bytes without a pattern."""
    rows = [np.empty(0, np.int64)]
    for low, _, offset, data in text_blocks(column):
        digit = (data >= 0x30) & (data <= 0x39)
        total = np.concatenate(([0], np.cumsum(digit)))
        dense = np.flatnonzero(total[np.minimum(np.arange(len(data)) + 24, len(data))] - total[:-1] >= 7)
        dotted = np.flatnonzero(digit[:-2] & (data[1:-1] == 0x2E) & digit[2:]) if len(data) > 2 else rows[0]
        raw, places = data.tobytes(), []
        for hint in _HINTS:
            name = hint.encode()
            at = raw.find(name)
            while at >= 0:
                places.append(at)
                at = raw.find(name, at + 1)
        found = np.concatenate((np.flatnonzero(data == 0x40), dense, dotted, np.array(places, np.int64)))
        rows.append(np.unique(np.searchsorted(offset, found, "right") - 1) + low)
    return np.concatenate(rows).tolist()


def entity_table(documents: DataFrame) -> DataFrame:
    """Distinct (doc_id, text hash, kind, value) of all documents, the surnames of persons included as a kind of their own."""
    hashed = documents.select("doc_id", F.xxhash64("text").alias("row"), "text")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, kinds, names = [], [], []
            for row in marked_rows(batch.column(2)):
                values = {(e.kind, e.value) for e in find_entities(batch.column(2)[row].as_py())}
                values |= {("surname", surname_of(value)) for kind, value in values if kind == "person"}
                for kind, value in values:
                    at.append(row)
                    kinds.append(kind)
                    names.append(value)
            columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns[:2]]
            texts = [pa.array(kinds, pa.string()), pa.array(names, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + texts, ["doc_id", "row", "kind", "value"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return hashed.mapInArrow(find, f"doc_id {kind}, row bigint, kind string, value string")


def _with_surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            made = pa.array([surrogate(key, kind, value, attempt) for kind, value, attempt in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], ["kind", "value", "attempt", "made"])

    schema = "kind string, value string, attempt int, made string"
    return entities.select("kind", "value", "attempt").mapInArrow(replace, schema)


def surrogate_table(values: DataFrame, key: bytes) -> DataFrame:
    """kind, value, attempt and made for distinct (kind, value): no two share a surrogate, and none is a real value.

    Of the entities that draw one surrogate, the one with the lowest attempt, then value, keeps it, and the others draw
    again; so do those whose surrogate occurs as an entity. Every round is an aggregate and two joins of the entities.
    What is written of persons is distinct only with their surnames among the values, as `entity_table` gives them.
    """
    table = written(_with_surrogates(values.withColumn("attempt", F.lit(0)), key), "surrogates")
    # A drawn surname is a stem, and its endings are written to it later.
    stem = F.when(F.col("kind") == "surname", F.regexp_replace("value", "^(cyrillic:.*)ова?$", "$1")).otherwise(F.col("value"))
    real = values.select("kind", stem.alias("made"), F.lit(True).alias("real")).distinct()
    while True:
        # What has been kept stays: an entity that draws again never takes a surrogate from one that need not.
        keeper = table.groupBy("kind", "made").agg(F.min(F.struct("attempt", "value")).alias("keeper"))
        checked = table.join(keeper, ["kind", "made"]).join(real, ["kind", "made"], "left")
        again = (F.col("keeper.value") != F.col("value")) | F.col("real").isNotNull()
        checked = checked.select("kind", "value", "attempt", "made", again.alias("again"))
        checked = written(checked, "surrogates")
        if not checked.filter("again").limit(1).count():
            return checked.drop("again")
        redrawn = _with_surrogates(checked.filter("again").withColumn("attempt", F.col("attempt") + 1), key)
        table = written(checked.filter("NOT again").drop("again").unionByName(redrawn), "surrogates")


def replace_pii(documents: DataFrame, key: bytes) -> DataFrame:
    """`documents` with personal data in `text` replaced, and _entities (kind, start, end, surrogate), places of the input.

    An entity's surrogate depends on the key, its kind and its normal form, so it is the same wherever the entity occurs,
    and different entities have different ones, over all documents. A person is written with one surrogate surname for
    each real one in a script, whether the full name is found or the surname alone. NULL texts stay NULL and have no entities; texts
    without entities stay as they are; repeated rows stay; other columns pass through, but for one named _entities or
    _redrawn. Entities whose first surrogate collides are few; only they are joined back to their documents.
    """
    documents = documents.drop("_entities", "_redrawn")
    found = written(entity_table(documents), "entities")
    table = surrogate_table(found.select("kind", "value").distinct(), key)
    redrawn = (
        found.join(table.filter("attempt > 0"), ["kind", "value"])
        .groupBy("doc_id", "row")
        .agg(F.collect_set(F.struct("kind", "value", "attempt")).alias("_redrawn"))
    )
    redrawn = written(redrawn.withColumnsRenamed({"doc_id": "_doc", "row": "_row"}), "redrawn")
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_row"))
    joined = documents.join(redrawn, same, "left").drop("_doc", "_row")
    place = documents.columns.index("text")
    kind = "array<struct<kind: string, start: int, end: int, surrogate: string>>"
    schema = documents.selectExpr("*", f"CAST(array() AS {kind}) AS _entities").schema
    arrow = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("surrogate", pa.string())])
    )

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            changed = {}
            for row in marked_rows(batch.column(place)):
                text = batch.column(place)[row].as_py()
                if entities := find_entities(text):
                    later = {(r["kind"], r["value"]): r["attempt"] for r in batch.column(batch.num_columns - 1)[row].as_py() or ()}
                    changed[row] = _replaced(text, entities, later, key)
            texts = batch.column(place)
            if changed:
                texts = pa.array([changed[i][0] if i in changed else t.as_py() for i, t in enumerate(texts)], texts.type)
            marks = pa.array([changed[i][1] if i in changed else [] for i in range(len(batch))], arrow)
            columns = batch.columns[:-1]
            columns[place] = texts
            yield pa.RecordBatch.from_arrays([*columns, marks], [*batch.schema.names[:-1], "_entities"])

    return joined.mapInArrow(replace, schema)


def _replaced(text: str, entities: list[Entity], later: dict[tuple[str, str], int], key: bytes) -> tuple[str, list[dict]]:
    parts, marks, at = [], [], 0
    for e in entities:
        attempt = later.get((e.kind, e.value), 0)
        if e.kind == "person":
            made = person_surrogate(key, e.value, attempt, later.get(("surname", surname_of(e.value)), 0))
        else:
            made = surrogate(key, e.kind, e.value, attempt)
        shown = render(e, text[e.start : e.end], made)
        parts += [text[at : e.start], shown]
        marks.append({"kind": e.kind, "start": e.start, "end": e.end, "surrogate": shown})
        at = e.end
    return "".join(parts) + text[at:], marks
