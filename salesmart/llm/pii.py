"""Personal data in texts: rules, and a linear-chain conditional random field over word shapes.

The rules find e-mail addresses, IP addresses, card and phone numbers exactly. The field is trained from a small labelled
table of texts with spans and adds spans of the same kinds that the rules miss, such as a number that fails a check or is written another way.

A text is read in chunks between white space. A chunk without a digit or an @ is outside every span by definition, in training and in
decoding, so the chain is in its outer state there, and the stretches of other chunks in between can be decoded on their own without
changing the best path. A stretch is cut into pieces (letters, digits, single other characters); features are the shapes of a piece, of
its neighbours and of its chunk, never the characters themselves. Viterbi runs over batches of stretches of like length. A found
span is kept if every piece of it is as probable as ``certain`` and no span of the rules overlaps it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import crf
from salesmart.llm.samples import capped_sample

# The kinds in their order, and the rules' patterns.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_SIGN = re.compile("[0-9@]")
_SPACE = re.compile(r"\s")
_PIECE = re.compile(r"[^\W\d_]+|[0-9]+|\S")

Span = tuple[str, int, int]


@dataclass(frozen=True)
class PiiSettings:
    """``documents``: bound of the labelled sample the query takes. ``sequences`` and ``longest``: distinct labelled stretches, and pieces of
    one, that are trained on at most. ``certain``: least probability of each piece of an added span."""

    documents: int = 4_000
    sequences: int = 4_000
    longest: int = 60
    certain: float = 0.95
    seed: int = 5
    fit: crf.Fit = crf.Fit()


# ---- rules


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As the leftmost non-overlapping matches of ``[A-Za-z0-9._%+-]+@`` and a domain, in time linear in the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(doubled) + sum(int(d) for d in digits[::-2])) % 10 == 0


def _octets(found: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found.split("."))


def rule_spans(text: str | None) -> list[Span]:
    """(kind, start, end) in code points, ordered by start and kind."""
    if not text:
        return []
    found = [("email", start, end) for start, end in _emails(text)]
    if _DIGIT.search(text):
        found += [("ip", *m.span()) for m in _IP.finditer(text) if _octets(m[0])]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


# ---- stretches, pieces and features


def _chunks(text: str) -> Iterator[tuple[int, int]]:
    """The chunks between white space that hold a digit or an @."""
    end, sign = 0, _SIGN.search(text)
    while sign:
        start = sign.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        space = _SPACE.search(text, sign.end())
        end = space.start() if space else len(text)
        yield start, end
        sign = _SIGN.search(text, end)


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Neighbouring chunks with nothing but white space between them."""
    held: list[tuple[int, int]] = []
    for start, end in _chunks(text):
        if held and not text[held[-1][1] : start].isspace():
            yield held
            held = []
        held.append((start, end))
    if held:
        yield held


def shape(piece: str) -> str:
    """Letters by case and length, digits by number, other characters as they are if ASCII."""
    if piece[0].isalpha():
        case = "x" if piece.islower() else "X" if piece.isupper() else "Xx"
        return case + str(min(len(piece), 6))
    if piece[0].isascii() and piece[0].isdigit():
        return "d" + str(min(len(piece), 20))
    return piece if piece.isascii() else "other"


def pieces_of(text: str, stretch: list[tuple[int, int]]) -> tuple[list[tuple[int, int]], list[list[str]]]:
    """Start and end of each piece, and its features."""
    places, shapes, ofs, gaps = [], [], [], []
    chunks = []
    for start, end in stretch:
        found = list(_PIECE.finditer(text, start, end))
        whole = [shape(m[0]) for m in found]
        digits = sum(int(s[1:]) for s in whole if s[0] == "d")
        chunks.append((digits, "".join(s[0] for s in whole[:12]), sum(s == "." for s in whole), "@" in whole))
        for i, m in enumerate(found):
            places.append(m.span())
            shapes.append(whole[i])
            ofs.append(len(chunks) - 1)
            gaps.append(i == 0)
    around = ["start", "start", *shapes, "end", "end"]
    out = []
    at_sign: dict[int, int] = {}
    for i, s in enumerate(shapes):
        if s == "@":
            at_sign.setdefault(ofs[i], i)
    for i, s in enumerate(shapes):
        digits, outline, dots, _ = chunks[ofs[i]]
        sign = at_sign.get(ofs[i])
        side = "none" if sign is None else "before" if i < sign else "after"
        last = i + 1 == len(shapes) or gaps[i + 1]
        features = [
            "bias", f"s={s}", f"p={around[i + 1]}{gaps[i]}", f"n={around[i + 3]}{last}", f"pp={around[i]},{around[i + 1]}", f"nn={around[i + 3]},{around[i + 4]}",
            f"pn={around[i + 1]},{s},{around[i + 3]}", f"o={outline},{s}", f"d={min(digits, 24)}", f"dots={min(dots, 5)},{s[0]}", f"@={side},{s[0]}",
            f"edge={gaps[i]}{last},{s}",
        ]
        if s in ("d1", "d2", "d3"):
            features.append(f"octet={int(text[slice(*places[i])]) <= 255}")
        out.append(features)
    return places, out


def tags_of(places: list[tuple[int, int]], spans: list[Span]) -> list[int]:
    """The state of each piece: 0 outside, 2 k + 1 at the start of a span of kind k, 2 k + 2 further in it. Of overlapping spans the first holds."""
    tags = [0] * len(places)
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        inside = [i for i, (a, b) in enumerate(places) if a >= start and b <= end]
        if inside and not any(tags[i] for i in inside):
            for i in inside:
                tags[i] = 2 * KINDS.index(kind) + 2
            tags[inside[0]] -= 1
    return tags


def _allowed() -> np.ndarray:
    """Inside a kind comes only what began as that kind."""
    n = 2 * len(KINDS) + 1
    out = np.ones((n, n), dtype=bool)
    for inner in range(2, n, 2):
        out[:, inner] = False
        out[[inner - 1, inner], inner] = True
    return out


# ---- the field


class Model:
    """A trained chain and the numbers of its features; without labelled stretches it finds nothing."""

    def __init__(self, features: dict[str, int], chain: crf.Chain | None):
        self.features, self.chain = features, chain

    def find(self, texts: list[str | None], certain: float) -> list[list[Span]]:
        """The spans of each text."""
        out: list[list[Span]] = [[] for _ in texts]
        owners, places, sequences = [], [], []
        for i, text in enumerate(texts if self.chain else ()):
            for stretch in stretches(text) if text else ():
                found, features = pieces_of(text, stretch)
                owners.append(i)
                places.append(found)
                sequences.append([[self.features[f] for f in fs if f in self.features] for fs in features])
        for rows in crf.batches([len(s) for s in sequences]):
            scores, lengths = self.chain.emissions([sequences[r] for r in rows])
            states, sure = self.chain.viterbi(scores, lengths), self.chain.marginals(scores, lengths)
            for r, path, of in zip(rows, states, sure, strict=True):
                out[owners[r]] += self._spans(places[r], path, of, certain)
        return out

    @staticmethod
    def _spans(places: list[tuple[int, int]], path: np.ndarray, sure: np.ndarray, certain: float) -> Iterator[Span]:
        i = 0
        while i < len(places):
            state, first = int(path[i]), i
            i += 1
            if not state:
                continue
            while i < len(places) and path[i] == state + 1:
                i += 1
            if min(sure[t, path[t]] for t in range(first, i)) >= certain:
                yield KINDS[(state - 1) // 2], places[first][0], places[i - 1][1]


def labelled_stretches(labelled: DataFrame, settings: PiiSettings) -> DataFrame:
    """features (a line per piece, tab-separated), tags (comma-separated), times: the distinct stretches of the labelled texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[str, str]] = Counter()
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                known = [(s["kind"], s["start"], s["end"]) for s in spans or ()]
                for stretch in stretches(text):
                    places, features = pieces_of(text, stretch)
                    if len(places) <= settings.longest:
                        near = [s for s in known if s[1] < stretch[-1][1] and s[2] > stretch[0][0]]
                        tags = ",".join(map(str, tags_of(places, near)))
                        counts["\n".join(map("\t".join, features)), tags] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())],
                ["features", "tags", "times"],
            )

    rows = labelled.where("text IS NOT NULL").select("text", "spans")
    found = rows.mapInArrow(work, "features string, tags string, times bigint")
    return found.groupBy("features", "tags").agg(F.sum("times").alias("times"))


def train(labelled: DataFrame, settings: PiiSettings = PiiSettings()) -> Model:
    """A model of ``labelled``: text, spans (array of struct of kind, start, end in code points).

    Null texts and spans that no piece fits are left out. Distinct labelled stretches go to the driver, ``sequences`` of
    them, chosen by hash, at most twice as many.
    """
    found = labelled_stretches(labelled, settings).withColumn("key", F.xxhash64("features", "tags"))
    rows = capped_sample(found, "key", settings.sequences, settings.seed).collect()
    rows.sort(key=lambda r: (r["features"], r["tags"]))
    features: dict[str, int] = {}
    sequences = [[[features.setdefault(f, len(features)) for f in line.split("\t")] for line in r["features"].split("\n")] for r in rows]
    if not sequences:
        return Model({}, None)
    labels = [[int(t) for t in r["tags"].split(",")] for r in rows]
    return Model(features, crf.fit(sequences, labels, [r["times"] for r in rows], len(features), _allowed(), settings.fit))


def rule_labelled(docs: DataFrame, settings: PiiSettings = PiiSettings()) -> DataFrame:
    """A small labelled table: texts of a bounded, hash-chosen sample of the documents with a digit or an @, with the spans of the rules."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in rule_spans(t)] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("text"), pa.array(spans, kind)], ["text", "spans"])

    signed = docs.where(F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id", "text").alias("key"), "text")
    chosen = capped_sample(signed, "key", settings.documents, settings.seed).select("text")
    return chosen.mapInArrow(work, "text string, spans array<struct<kind: string, start: int, end: int>>")


def find_personal_data(docs: DataFrame, model: Model, settings: PiiSettings = PiiSettings()) -> DataFrame:
    """Each row's doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the rules' spans) and spans (theirs and the model's).

    ``docs``: doc_id, text. Spans are ``kind:start:end`` in code points, the end exclusive, by start and then kind (email, ip, card,
    phone), joined with commas. The counts are of the rules' spans, of which each kind's are the leftmost that do not overlap; those of
    different kinds may. A null or empty text has no spans. Repeated rows and rows without doc_id are looked at
    like others. An empty table gives an empty result. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_sha256", "spans"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, digests, lists = [], [], []
            for text, more in zip(texts, shared.value.find(texts, settings.certain), strict=True):
                base = rule_spans(text)
                added = [s for s in more if all(s[2] <= b[1] or s[1] >= b[2] for b in base)]
                counts.append([sum(s[0] == kind for s in base) for kind in KINDS])
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                lists.append(written(sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(lists, pa.string())], names)

    schema = f"doc_id bigint, {', '.join(f'n_{kind} bigint' for kind in KINDS)}, base_sha256 string, spans string"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, schema)
