"""Personal data replaced by keyed surrogates of the same type and form.

Found are e-mail addresses, phone numbers, payment cards (by check digit), IP
addresses, IBANs (by check digits), social security numbers, access keys, secrets
after a word like ``password=``, and names after a title or a known given name.

The surrogate of an entity is a keyed function of its type and canonical form, so
an entity keeps one surrogate in all documents and all spellings: digits go into the
places of the digits, capitals follow capitals, check digits are right, private addresses
stay private, names keep gender and script.  Surrogates of all entities of the table are
checked: where two entities meet in one surrogate, or a surrogate is itself an entity
of the table, all but the least move to their next surrogate, until none meet.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanery.sources.scratch import written

#: Corrections up to this many are sent to every task; more are joined.
SENT = 50_000

#: Given names by script and gender, and titles by gender.
GIVEN = {
    ("latin", "f"): "Anna Maria Emma Laura Julia Sofia Clara Elena Sarah Alice Marie Camille Hannah Carmen Lucia Mary Patricia Jennifer Linda Elizabeth".split(),
    ("latin", "m"): "John James Robert Michael William David Peter Thomas Daniel Paul Jean Pierre Hans Karl Stefan Carlos Jose Luis Miguel Antonio".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Алексей Дмитрий Сергей Андрей Михаил Николай Павел Виктор Олег".split(),
}
TITLES = {
    "f": "Mrs. Mrs Ms. Ms Miss Frau Madame Mme Señora Sra. Г-жа".split(),
    "m": "Mr. Mr Herr Monsieur Señor Sr. Г-н".split(),
}
_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
_TITLED = {t: g for g, titles in TITLES.items() for t in titles}

_UP, _LOW = "A-ZÀ-ÖØ-ÞА-ЯЁ", "a-zß-öø-ÿа-яё"
_CAPITALISED = re.compile(rf"(?<![\w-])([{_UP}](?:-?[{_LOW}]+)\.?) +([{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)?)(?: +([{_UP}][{_LOW}]+(?:-[{_UP}][{_LOW}]+)?))?")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-]@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_KEY = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")
_SECRET = re.compile(r"(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key))[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9_\-+/]{8,})")
_DIGITS = re.compile(r"\d")
_NUMBERS = (
    ("iban", re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("phone", re.compile(r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}([.-])\d{3}\1\d{4}(?![\d-])")),
    ("phone", re.compile(r"\+[2-9]\d{0,2}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d)")),
    ("card", re.compile(r"(?<![\d.+-])\d(?:[ -]?\d){12,18}(?![\d-])")),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
)

Found = tuple[int, int, str, str]


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits)))
    return sum(doubled) % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _canonical(kind: str, shown: str) -> str | None:
    """The form all spellings of an entity share, or None if *shown* is none."""
    digits = re.sub(r"\D", "", shown)
    if kind == "card":
        return digits if _luhn(digits) and len(set(digits)) > 1 else None
    if kind == "ip":
        octets = [int(x) for x in shown.split(".")]
        return ".".join(map(str, octets)) if max(octets) < 256 else None
    if kind == "iban":
        plain = shown.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and _mod97(plain) == 1 else None
    if kind == "phone":
        return (digits[1:] if shown[:2] == "+1" else digits if shown[0] != "+" else "+" + digits) if 7 <= len(digits) <= 15 else None
    if kind == "email":
        return shown.lower()
    return digits if kind == "ssn" else shown


def _names(text: str) -> Iterator[Found]:
    at = 0
    while m := _CAPITALISED.search(text, at):
        first, second, third = m.groups()
        titled, at = _TITLED.get(first), m.start(2)
        if titled is None and first not in _GENDER:
            continue
        if titled is None:
            script, gender = _GENDER[first]
            yield m.start(1), m.end(1), f"given {script} {gender}", first
            yield m.start(2), m.end(2), f"surname {script} {gender if script == 'cyrillic' else '-'}", second
            at = m.end(2)
        elif second in _GENDER and third:
            continue  # the given name comes next
        else:
            script = "cyrillic" if second[0] > "\u03ff" else "latin"
            yield m.start(2), m.end(2), f"surname {script} {titled if script == 'cyrillic' else '-'}", second
            at = m.end(2)


def detect(text: str) -> list[Found]:
    """Start, end, type and canonical form of the entities of *text*, in order, without overlap."""
    found: list[Found] = []

    def add(start: int, end: int, kind: str, canonical: str | None) -> None:
        if canonical is not None and all(end <= s or start >= e for s, e, *_ in found):
            found.append((start, end, kind, canonical))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add(m.start(), m.end(), "email", _canonical("email", m[0]))
    if _DIGITS.search(text):
        for m in _KEY.finditer(text):
            add(m.start(), m.end(), "key", m[0])
        if "=" in text or ":" in text:
            for m in _SECRET.finditer(text):
                add(m.start(1), m.end(1), "secret", m[1] if _DIGITS.search(m[1]) else None)
        for kind, pattern in _NUMBERS:
            for m in pattern.finditer(text):
                add(m.start(), m.end(), kind, _canonical(kind, m[0]))
    for name in _names(text):
        add(*name)
    return sorted(found)


class _Stream:
    """Numbers below a bound, by a keyed hash of an entity and an attempt."""

    def __init__(self, key: bytes, *parts: str):
        self._key, self._label, self._block, self._left = key, "\0".join(parts).encode(), 0, 0

    def below(self, n: int) -> int:
        if self._left < n << 32:
            digest = hmac.new(self._key, self._label + b"\0%d" % self._block, hashlib.sha256).digest()
            self._left, self._block = int.from_bytes(digest), self._block + 1
        self._left, value = divmod(self._left, n)
        return value

    def like(self, text: str) -> str:
        """Letters for letters and digits for digits; long numbers in hexadecimal stay so."""
        pools = ("0123456789abcdef",) * 2 if re.fullmatch("(?=.*[0-9])(?=.*[a-f])[0-9a-f]{8,}", text) else ("abcdefghijklmnopqrstuvwxyz", "0123456789")
        out = []
        for c in text:
            pool = pools[c.isdigit()] if c.isalnum() else c
            new = pool[self.below(len(pool))]
            out.append(new.upper() if c.isupper() else new)
        return "".join(out)


_SYLLABLES = {
    "latin": ([c + v for c in "bdfgklmnprstvw" for v in "aeiou"], ("er", "son", "mann", "ez", "ley", "ard")),
    "cyrillic": ([c + v for c in "бвгдзклмнпрст" for v in "аеиоу"], ("ов", "ев", "ин")),
}


def surrogate(key: bytes, kind: str, canonical: str, attempt: int) -> str:
    """The *attempt*-th surrogate of an entity, in canonical form."""
    draw = _Stream(key, kind, canonical, str(attempt))
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        more = "".join(str(draw.below(10)) for _ in range(attempt // 4))  # short names run out
        labels = domain.split(".")
        reserved = labels[-1] == "example" or labels[-2:-1] == ["example"]
        own = _Stream(key, "domain", domain)
        return f"{draw.like(local)}{more}@" + (domain if reserved else ".".join([*map(own.like, labels[:-1]), "example"]))
    if kind == "phone":
        keep = 3 if canonical[0] == "+" else 0
        rest = [draw.below(10) for _ in canonical[keep:]]
        if not keep:
            rest[0] = 2 + draw.below(8)
        return canonical[:keep] + "".join(map(str, rest))
    if kind == "card":
        body = canonical[0] + "".join(str(draw.below(10)) for _ in canonical[2:])
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind == "ip":
        a, b, *_ = octets = list(map(int, canonical.split(".")))
        fixed = 1 if a in (10, 127) else 2 if (a, b) == (192, 168) or a == 172 and 16 <= b < 32 else 0
        new = [draw.below(256) for _ in octets]
        if not fixed:
            new[0] = (octet := 1 + draw.below(221)) + (octet >= 10) + (octet >= 126)
            new[1] = draw.below(256) if new[0] not in (172, 192) else draw.below(16)
        return ".".join(map(str, octets[:fixed] + new[fixed:]))
    if kind == "iban":
        body = canonical[:2] + "00" + draw.like(canonical[4:])
        return body[:2] + f"{98 - _mod97(body):02d}" + body[4:]
    if kind == "ssn":
        return f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
    if kind == "key":
        return canonical[:4] + draw.like(canonical[4:])
    if kind == "secret":
        return draw.like(canonical)
    part, script, gender = kind.split(" ")
    if part == "given":  # the keyed order of the known names, each giving the next
        ring = sorted(GIVEN[script, gender], key=lambda name: hmac.digest(key, name.encode(), "sha256"))
        return ring[(ring.index(canonical) + 1) % len(ring)]
    syllables, endings = _SYLLABLES[script]
    stem = "".join(syllables[draw.below(len(syllables))] for _ in range(2 + attempt // 4))
    return stem.capitalize() + endings[draw.below(len(endings))] + ("а" if gender == "f" else "")


def render(kind: str, shown: str, new: str) -> str:
    """*new* in the form in which the entity is *shown*."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(re.sub(r"\D", "", new if shown[:2] != "+1" else "1" + new))
        return "".join(next(digits) if c.isdigit() else c for c in shown)
    if kind == "iban":
        rest = iter(new)
        return "".join(c if c == " " else next(rest) for c in shown)
    if kind == "email":
        return "".join(c.upper() if i < len(shown) and shown[i].isupper() else c for i, c in enumerate(new))
    return new


def _texts(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for batch in batches:
        yield batch, batch.column(text).to_pylist()


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """The distinct entities (kind, canonical) of all texts; each task names an entity once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _texts(batches, text):
            found = list({(kind, canonical) for t in texts if t for *_, kind, canonical in detect(t)})
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in found], pa.string()), "canonical": pa.array([c for _, c in found], pa.string())})

    return docs.select(text).mapInArrow(run, "kind string, canonical string").distinct()


def _with_surrogates(rows: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [surrogate(key, k, c, a) for k, c, a in zip(*(batch.column(x).to_pylist() for x in ("kind", "canonical", "attempt")), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.string())], names=[*batch.schema.names, "new"])

    return rows.mapInArrow(run, "kind string, canonical string, attempt int, new string")


def corrections(found: DataFrame, key: bytes, rounds: int = 40) -> DataFrame:
    """Entities (kind, canonical, attempt) of stored *found* whose first surrogate is taken: attempt is the first that is free."""
    own = found.filter(~F.col("kind").startswith("given"))
    now = written(_with_surrogates(own.withColumn("attempt", F.lit(0)), key), "surrogates")
    real = own.select("kind", F.col("canonical").alias("new"), F.lit(True).alias("real"))
    for _ in range(rounds):
        first = now.groupBy("kind", "new").agg(F.min("canonical").alias("first"), F.count("*").alias("n"))
        taken = first.join(real, ["kind", "new"], "left").filter("n > 1 or real")
        bad = now.join(taken, ["kind", "new"]).filter("real or canonical <> first")
        bad = written(bad.select("kind", "canonical", F.col("attempt") + 1), "taken", compact=True).toDF("kind", "canonical", "attempt")
        if bad.isEmpty():
            return now.filter("attempt > 0").select("kind", "canonical", "attempt")
        moved = _with_surrogates(bad, key)
        now = written(now.join(bad.select("kind", "canonical"), ["kind", "canonical"], "left_anti").unionByName(moved), "surrogates")
    raise RuntimeError(f"surrogates still meet after {rounds} rounds")


def replace(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """*docs* with the personal data of *text* replaced, and n_entities, the count of replaced places.

    NULL and empty texts stay as they are with a count of 0.  All other columns and
    repeated rows are kept; a column n_entities is replaced.
    """
    rows = docs.drop("n_entities")
    found = written(entities(rows, text), "entities", compact=True)
    moved = written(corrections(found, key), "corrections", compact=True)
    schema = T.StructType([*rows.schema.fields, T.StructField("n_entities", T.LongType())])
    if moved.count() <= SENT:
        sent = rows.sparkSession.sparkContext.broadcast({(r.kind, r.canonical): r.attempt for r in moved.collect()})
        return rows.mapInArrow(_rewrite(key, text, sent, None), schema)
    # Each row's own corrections, joined by the row's place in stored files.
    rows = written(rows, "documents")
    spot = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    named = _mentions(rows.select(*spot, F.col(text).alias("text"))).join(moved, ["kind", "canonical"])
    lists = named.groupBy("_file", "_row").agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("_moved"))
    placed = rows.select("*", *spot).join(lists, ["_file", "_row"], "left").drop("_file", "_row")
    return placed.mapInArrow(_rewrite(key, text, None, "_moved"), schema)


def _mentions(rows: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, "text"):
            found = [(i, *e) for i, t in enumerate(texts) if t for e in {(k, c) for *_, k, c in detect(t)}]
            at = pa.array([i for i, *_ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array([k for _, k, _ in found], pa.string()), pa.array([c for *_, c in found], pa.string())],
                names=["_file", "_row", "kind", "canonical"],
            )

    return rows.mapInArrow(run, "_file string, _row bigint, kind string, canonical string")


def _rewrite(key: bytes, text: str, sent, listed: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, text):
            new, counts = [], []
            lists = batch.column(listed).to_pylist() if listed else [None] * len(texts)
            for t, own in zip(texts, lists, strict=True):
                attempts = sent.value if listed is None else {(m["kind"], m["canonical"]): m["attempt"] for m in own or ()}
                out, at = [], 0
                places = detect(t) if t else []
                for start, end, kind, canonical in places:
                    value = surrogate(key, kind, canonical, attempts.get((kind, canonical), 0))
                    out += [t[at:start], render(kind, t[start:end], value)]
                    at = end
                new.append("".join([*out, t[at:]]) if places else t)
                counts.append(len(places))
            columns = [pa.array(new, pa.string()) if n == text else batch.column(n) for n in batch.schema.names if n != listed]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*(n for n in batch.schema.names if n != listed), "n_entities"])

    return run
