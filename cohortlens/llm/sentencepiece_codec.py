"""SentencePiece encoding and decoding on the tokenizers library.

The model protobuf is read field by field and rebuilt as a tokenizer:
its normaliser (precompiled character map, extra white space, dummy prefix),
the metaspace marker for blanks, its unigram scores or, for a BPE model, the
merges that its scores imply, and byte fallback. Texts are cut before every
marker run, which no piece of the vocabulary crosses (checked when the model
is built; else whole texts are encoded). A process remembers the words it has
seen, up to a bound; a block's new words are encoded in batches, by several
threads.

Every row is verified twice: the sentencepiece library encodes its whole text
and must give the same ids, and decoding them must give the text again. Equal
texts of a block go through all of this once.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import prepare, table
from cohortlens.llm.kernels import string_bytes, text_blocks

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
THREADS = 2
AUDIT = 1
BLOCK, BATCH, JOINED = 1 << 20, 256, 32  # bytes of text, strings of a batch, and new words of a string
WORDS, CHARS = 1 << 19, 1 << 25  # words that a process remembers, and their characters: some 150 MB
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_TOKENIZERS: dict[tuple[str, int], tuple] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; fixed-size values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at:at + size]
        at += size


def parse_model(data: bytes) -> dict:
    """Pieces (piece, score, type), model type, byte fallback and normaliser
    settings of a serialised sentencepiece ModelProto."""
    out = {"pieces": [], "type": 1, "byte_fallback": False, "charsmap": b"", "dummy_prefix": True, "trim": True,
           "escape": True, "unk_id": 0}
    for field, value in _fields(data):
        if field == 1:
            piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(_fields(value))
            out["pieces"].append((piece[1].decode(), float(np.frombuffer(piece[2], "<f4")[0]), piece[3]))
        elif field == 2:
            trainer = dict(_fields(value))
            out["type"] = trainer.get(3, 1)
            out["byte_fallback"] = bool(trainer.get(35, 0))
        elif field == 3:
            norm = dict(_fields(value))
            out |= {"charsmap": norm.get(2, b""), "dummy_prefix": bool(norm.get(3, 1)), "trim": bool(norm.get(4, 1)),
                    "escape": bool(norm.get(5, 1))}
    out["unk_id"] = next((i for i, p in enumerate(out["pieces"]) if p[2] == UNKNOWN), 0)
    return out


def word_pattern(model: dict) -> str | None:
    """What normalised texts are cut into; None if a piece crosses the cuts."""
    usable = [p for p, _, kind in model["pieces"] if kind in (NORMAL, USER)]
    if any(MARK in p.lstrip(MARK) for p in usable):
        return None
    # a line break that only byte fallback can write never merges either
    alone = "" if any("\n" in p for p in usable) else "\n"
    return f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + (f"|{alone}+" if alone else "")


def build_tokenizer(model: dict):
    """A tokenizers.Tokenizer with the ids of ``model``."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    pieces = model["pieces"]
    usable = {p: (i, s) for i, (p, s, kind) in enumerate(pieces) if kind in (NORMAL, USER)}
    if model["type"] == 1:
        core = models.Unigram([(p, s if kind in (NORMAL, USER) else -1e4) for p, s, kind in pieces],
                              unk_id=model["unk_id"], byte_fallback=model["byte_fallback"])
    elif model["type"] == 2:
        merges = []  # best score first; among equal scores the longer left part, so runs grow from the left
        for piece, (_, score) in usable.items():
            for cut in range(1, len(piece)):
                left, right = usable.get(piece[:cut]), usable.get(piece[cut:])
                if left and right:
                    merges.append((-score, -cut, left[0], right[0], piece[:cut], piece[cut:]))
        core = models.BPE(vocab={p: i for i, (p, _, _) in enumerate(pieces)}, merges=[m[4:] for m in sorted(merges)],
                          unk_token=pieces[model["unk_id"]][0], fuse_unk=True, byte_fallback=model["byte_fallback"])
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(core)
    steps = []
    if model["charsmap"]:
        steps.append(normalizers.Precompiled(model["charsmap"]))
    if model["trim"]:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ +| +$"), "")]
    if model["dummy_prefix"]:
        steps.append(normalizers.Prepend(" "))
    if model["escape"]:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        tokenizer.normalizer = normalizers.Sequence(steps)
    words = word_pattern(model)
    if words:
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(words), "isolated")
    tokenizer.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
                                          + ([decoders.Strip(" ", 1, 0)] if model["dummy_prefix"] else []))
    return tokenizer


def load_tokenizer(path: str, threads: int = THREADS):
    """(tokenizer, model, word coder) of this process; built once."""
    key = (path, threads)
    if key not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        with open(path, "rb") as f:
            model = parse_model(f.read())
        tokenizer = build_tokenizer(model)
        _TOKENIZERS[key] = (tokenizer, model, WordCoder(tokenizer, model))
    return _TOKENIZERS[key]


class WordCoder:
    """Ids of texts by way of their words. A word is a marker run and what
    follows up to the next; its ids do not depend on what stands around it.
    Words stay known from block to block; beyond ``capacity`` words, or
    ``CHARS`` characters, all are forgotten after the block."""

    def __init__(self, tokenizer, model: dict, capacity: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.capacity = tokenizer, capacity
        self.whole = word_pattern(model) is None
        # a normaliser that only writes markers for blanks: the text's own blanks cut it
        self.plain = not model["charsmap"] and not model["trim"] and model["dummy_prefix"] and model["escape"]
        self.words = Tokenizer(tokenizer.model)
        self.starts = np.array([p.startswith(MARK) for p, _, _ in model["pieces"]])
        self.marked = any(p == MARK and kind in (NORMAL, USER) for p, _, kind in model["pieces"])
        self.find = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall
        self._forget()

    def _forget(self) -> None:
        self.place: defaultdict[str, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.flat, self.ends, self.chars = np.zeros(1 << 16, np.int32), np.zeros(1, np.int64), 0

    def _cut(self, text: str) -> list[str]:
        """A text's words; for a plain normaliser without their first marker."""
        if not text:  # the normaliser's dummy prefix would give it a piece, which encoding does not
            return []
        if not self.plain:
            return self.find(self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text)
        if "  " not in text and MARK not in text and text[0] != " ":  # no marker run
            return text.split(" ")
        return [w[1:] for w in self.find(MARK + text.replace(" ", MARK))]

    def _learn(self) -> None:
        """Encode the words that are new, in batches."""
        known = len(self.ends) - 1
        fresh = list(islice(self.place, known, None))
        if not fresh:
            return
        self.chars += sum(map(len, fresh))
        if self.plain:
            fresh = [MARK + w for w in fresh]
        flat, size = self._ids(fresh)
        ends = self.ends[-1] + np.cumsum(size)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat[:self.ends[-1]], np.zeros(max(2 * len(self.flat), int(ends[-1])), np.int32)])
        self.flat[self.ends[-1]:ends[-1]] = flat
        self.ends = np.concatenate([self.ends, ends])

    def _ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number by word). Words with one marker, ahead,
        are encoded some at a time as one string: a piece with a marker ahead
        begins a word there."""
        single = np.array([self.marked and w[:1] == MARK and w.find(MARK, 1) < 0 for w in words], bool)
        plain = [words[i] for i in np.flatnonzero(single)]
        ids = self._batches(["".join(plain[lo:lo + JOINED]) for lo in range(0, len(plain), JOINED)])
        flat = np.fromiter(chain.from_iterable(ids), np.int32)
        starts = np.flatnonzero(self.starts[flat])
        if len(starts) != len(plain):  # no vocabulary seen does that
            single[:] = False
        other = self._batches([words[i] for i in np.flatnonzero(~single)])
        size = np.zeros(len(words), np.int64)
        size[~single] = [len(x) for x in other]
        if single.any():
            size[single] = np.diff(np.append(starts, len(flat)))
        out = np.empty(int(size.sum()), np.int32)
        of = np.repeat(single, size)
        out[of] = flat if single.any() else []
        out[~of] = np.fromiter(chain.from_iterable(other), np.int32)
        return out, size

    def _batches(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for lo in range(0, len(texts), BATCH) for e in self.words.encode_batch_fast(texts[lo:lo + BATCH], add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, cuts by text): what the tokenizer's encode gives."""
        if self.whole:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            return np.fromiter(chain.from_iterable(ids), np.int32, int(cuts[-1])), cuts
        words = [self._cut(x) for x in texts]
        which = np.fromiter(map(self.place.__getitem__, chain.from_iterable(words)), np.int64)
        self._learn()
        first, size = self.ends[which], np.diff(self.ends)[which]
        ends = np.concatenate([[0], np.cumsum(size)])
        out = self.flat[np.repeat(first - ends[:-1], size) + np.arange(ends[-1])]
        if len(self.place) > self.capacity or self.chars > CHARS:
            self._forget()
        return out, ends[np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)]


def piece_bytes(model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of what each id decodes to, end to end."""
    parts = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else p.replace(MARK, " ").encode()
             for p, _, kind in model["pieces"]]
    return np.frombuffer(b"".join(parts), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def decode_ids(ids: np.ndarray, cuts: np.ndarray, model: dict) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of id sequences laid end to end, cut at ``cuts``: what
    the tokenizer's decoder gives, for a whole block at once."""
    flat, offs = piece_bytes(model)
    size = (offs[1:] - offs[:-1])[ids]
    ends = np.cumsum(size)
    at = np.repeat(offs[ids] - (ends - size), size) + np.arange(int(size.sum()))
    out = flat[at]
    bounds = np.concatenate([[0], ends])[cuts]
    if model["dummy_prefix"]:
        keep = np.ones(len(out), bool)
        first = bounds[:-1][bounds[1:] > bounds[:-1]]
        first = first[out[first] == 32]
        keep[first] = False
        bounds = bounds - np.searchsorted(first, bounds)
        out = out[keep]
    return out, bounds


def _equal(flat: np.ndarray, cuts: np.ndarray, at: np.ndarray, other: list[list[int]]) -> np.ndarray:
    """Which texts ``at`` have the ids that ``other`` gives them."""
    size = np.fromiter(map(len, other), np.int64, len(other))
    theirs = np.fromiter(chain.from_iterable(other), np.int32, int(size.sum()))
    same = np.diff(cuts)[at] == size
    ends = np.cumsum(size)
    span = np.where(same, size, 0)
    mine = np.repeat(cuts[:-1][at] - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
    places = np.repeat(ends - size - (np.cumsum(span) - span), span) + np.arange(int(span.sum()))
    wrong = np.repeat(np.arange(len(at)), span)[flat[mine] != theirs[places]]
    same[wrong] = False
    return same


def encode(docs: DataFrame, model: str = MODEL, threads: int = THREADS, audit_every: int = AUDIT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns are ignored):
    doc_id, ids array<int>, n_tokens, n_bytes (ids that are fallback bytes),
    round_trip (decoding the ids gives the text again; false for models whose
    normaliser changes the text), parity (the sentencepiece library gives
    the same ids; null only with ``audit_every`` other than 1: 0 audits no row,
    n the rows whose text hash it divides).

    ``model`` is a path that every executor can read. A null or empty text has
    no ids; null and repeated doc_ids are rows like any other.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, parsed, coder = load_tokenizer(model, threads)
        is_byte = np.array([kind == BYTE for _, _, kind in parsed["pieces"]])
        reference = None
        for rows, buf, offs in text_blocks(batches, limit=BLOCK):
            place: dict[str, int] = {}
            row_of = np.array([place.setdefault(x or "", len(place)) for x in rows.column(1).to_pylist()], np.int64)
            texts = list(place)
            _, own = np.unique(row_of, return_index=True)  # a row of each text
            flat, cuts = coder.encode(texts)
            out, bounds = decode_ids(flat, cuts, parsed)
            same = [bounds[i + 1] - bounds[i] == offs[r + 1] - offs[r]
                    and np.array_equal(out[bounds[i]:bounds[i + 1]], buf[offs[r]:offs[r + 1]]) for i, r in enumerate(own)]
            fallback = np.concatenate([[0], np.cumsum(is_byte[flat])])
            audit = rows.column(2).to_numpy(zero_copy_only=False)[own] % audit_every == 0 if audit_every else np.zeros(len(texts), bool)
            parity = np.zeros(len(texts), bool)
            if audit.any():
                if reference is None:
                    import sentencepiece

                    reference = sentencepiece.SentencePieceProcessor(model_file=model)
                at = np.flatnonzero(audit)
                parity[at] = _equal(flat, cuts, at, reference.encode([texts[i] for i in at], num_threads=threads))
            found = pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(flat)), pa.array(np.diff(cuts)), pa.array(np.diff(fallback[cuts])),
                 pa.array([bool(x) for x in same]), pa.array(parity, mask=~audit)], names=["ids", "n_tokens", "n_bytes", "round_trip", "parity"])
            if len(texts) < len(row_of):
                found = found.take(pa.array(row_of))
            yield pa.RecordBatch.from_arrays([rows.column(0), *found.columns], names=["doc_id", *found.schema.names])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("mark"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, n_bytes long, round_trip boolean, parity boolean")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids decode to the empty text."""
    prepare(encoded.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(model)[0]
        for batch in batches:
            texts = tokenizer.decode_batch([x or [] for x in batch.column(1).to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _digest(encoded: DataFrame) -> DataFrame:
    """The ids as one SHA-256 (little-endian 32-bit ids) instead of a list."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            offs, flat = np.asarray(ids.offsets), ids.values.to_numpy(zero_copy_only=False).astype("<i4")
            digests = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(offs[:-1], offs[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(digests)],
                                             names=["doc_id", *batch.schema.names[2:], "ids_sha256"])

    return encoded.mapInArrow(run, "doc_id long, n_tokens long, n_bytes long, round_trip boolean, parity boolean, ids_sha256 string")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded, decoded and compared."""
    return _digest(encode(table(spark, sf_dir, "documents")))
