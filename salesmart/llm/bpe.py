"""BPE encoding and decoding with forced-boundary splitting (operator 3).

Two adjacent bytes that stand side by side inside no vocabulary token can
never be joined by a merge, so every such byte pair is a certain cut.  A text
is cut at the vocabulary's special tokens, at white space where the tokenizer
drops it, at the pre-tokenizer's borders and at these byte pairs; fragments
are encoded on their own and their ids are concatenated.  The result equals the
tokenizers library's on the whole text.

Words between the white space that the tokenizer drops (whole texts, if it
drops none) are looked up by 128-bit hashes, all of a run of texts at once, in
``WordIds``: sorted arrays in two generations, some 30 bytes a word, so what is
no longer met goes and what is in use stays.  Only new words are cut and encoded.

The tokenizer's JSON (a vocabulary file, a few MB whatever the corpus) is read
once on the driver and travels with the tasks; a task holds one batch of texts
and at most two generations of ``CACHE`` words, and ``PIECES`` pre-tokens.

Defined cases: null and empty texts have no ids; null or empty id lists decode
to an empty text; unknown ids are skipped; repeated rows give repeated rows;
columns named like an output are replaced by it.
"""

from __future__ import annotations

import gc
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from salesmart.llm.common import _BYTE, _BYTE_OTHER, span_hashes, text_batches, text_buffer, word_spans

CACHE, CACHE_IDS, PIECES = 400_000, 4_000_000, 100_000
RUN = 1 << 20  # bytes of text, or four times as many ids, that a task handles at once

# Letters of the Latin blocks below U+0250 are their own NFC form and have one
# meaning in every Unicode version: for them ``str.lower`` and ``regex`` agree
# with the library.  Other words go through the library's own components.
_PLAIN = re.compile("[\x21-\x7e¡-¬®-ɏ]+")


# Code points of simple words: printable ASCII without the apostrophe (contractions
# look further than one code point) and the Latin letters up to U+00FF.
_SIMPLE = [c for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)] if c not in (0x27, 0xD7, 0xF7)]
_SIMPLE_BYTES = 64
_NEVER = np.int64(1 << 40)

_DROPPED = np.zeros(256, bool)
_DROPPED[[0x20, 0x09, 0x0A, 0x0D]] = True


def ragged(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``flat[start : start + count]`` of all pairs, end to end."""

    before = np.cumsum(counts) - counts
    return flat[np.repeat(starts - before, counts) + np.arange(int(counts.sum()))]


class WordIds:
    """Ids of words by their two hashes: arrays sorted by the first."""

    def __init__(self, h: np.ndarray | None = None, check: np.ndarray | None = None, starts: np.ndarray | None = None, counts: np.ndarray | None = None, flat: np.ndarray | None = None):
        empty = lambda t: np.zeros(0, t)
        self.h, self.check = (empty(np.uint64), empty(np.uint64)) if h is None else (h, check)
        self.starts, self.counts, self.flat = (empty(np.int64), empty(np.int32), empty(np.int32)) if h is None else (starts, counts, flat)

    def find(self, h: np.ndarray, check: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which are known, and the places of those."""

        if not len(self.h):
            return np.zeros(len(h), bool), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        known = (self.h[place] == h) & (self.check[place] == check)
        return known, place[known]

    def with_words(self, h: np.ndarray, check: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> WordIds:
        """These and other words, whose ids are ``flat`` in their order (of
        words that agree in the first hash one is kept)."""

        starts = np.append(self.starts, np.cumsum(counts, dtype=np.int64) - counts + len(self.flat))
        every, at = np.unique(np.append(self.h, h), return_index=True)
        return WordIds(every, np.append(self.check, check)[at], starts[at], np.append(self.counts, counts)[at].astype(np.int32), np.append(self.flat, flat))


def _byte_letters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the letters from U+0100 on, in byte order."""

    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class ForcedBoundaryBPE:
    """Encoder and decoder of one tokenizer (made once per task)."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        parsed = json.loads(spec)
        model = parsed["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE tokenizer is needed")
        whole = Tokenizer.from_str(spec)
        self.normalizer, self.pre = whole.normalizer, whole.pre_tokenizer
        self.suffix = model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]

        def alone(suffix: str) -> Tokenizer:
            options = {"end_of_word_suffix": suffix} if suffix else {}
            return Tokenizer(BPE(vocab=vocab, merges=merges, **options))

        self.final = alone(self.suffix)
        self.inner = alone("") if self.suffix else self.final
        self.special = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = _byte_letters()
        self.letter_of = dict(enumerate(self.letters))
        # which byte letters (below U+0200) stand side by side in a token
        self.pairs = np.zeros((512, 512), bool)
        for token in vocab:
            codes = [*map(ord, token.removesuffix(self.suffix) if self.suffix else token)]
            self.pairs[codes[:-1], codes[1:]] = True
        self.drops_space = not self.pieces(" ") and not self.pieces("\n")
        split = next((p["pattern"]["Regex"] for p in (parsed.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split" and p.get("invert")), None)
        kinds = [n["type"] for n in (parsed.get("normalizer") or {}).get("normalizers", [])]
        self.plain_pieces = regex.compile(f"\n|{split}") if split and self.drops_space and kinds == ["NFC", "Replace", "Lowercase"] else None
        self.young, self.old = WordIds(), WordIds()
        self._prepare_merges(vocab, merges, bool(model.get("ignore_merges") or model.get("dropout")))
        self.known_pieces: dict[str, bytes] = {}

    def _prepare_merges(self, vocab: dict[str, int], merges: list[tuple[str, str]], other: bool) -> None:
        """Tables of the vectorised path: for words of ``_SIMPLE`` code points,
        what the splitting pattern does between two of them, ids of single
        bytes, and the merges as sorted pairs of ids."""

        ends = [c + self.suffix for c in self.letters]
        self.simple = None
        if other or self.plain_pieces is None or not all(c in vocab for c in [*self.letters, *ends]):
            return
        begins = {ord(t[0]) for t in self.special}
        codes = [c for c in _SIMPLE if c not in begins and chr(c).lower() not in map(chr, begins)]
        low = sorted({ord(chr(c).lower()) for c in codes})
        found = self._plain_pieces_of([chr(a) + chr(b) for a in low for b in low])
        self.splits = np.zeros((256, 256), bool)
        self.splits[np.repeat(low, len(low)), np.tile(low, len(low))] = [len(f) == 2 for f in found]
        self.simple = np.zeros(256, bool)
        self.simple[codes] = True
        self.byte_ids = np.array([vocab[c] for c in self.letters]), np.array([vocab[c] for c in ends])
        self.byte_codes = np.array([ord(c) for c in self.letters])
        pair = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pair, kind="stable")
        self.merge_pairs, self.merge_ranks = pair[order], order
        self.merge_ids = np.array([vocab[a + b] for a, b in merges], np.int64)

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pair = (a << 32) | b
        at = np.minimum(np.searchsorted(self.merge_pairs, pair), len(self.merge_pairs) - 1)
        return np.where(self.merge_pairs[at] == pair, self.merge_ranks[at], _NEVER)

    def merged(self, ids: np.ndarray, joined: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """BPE of many fragments side by side: ids and their owners afterwards.
        ``joined``: whether an id and the next are of one fragment.  A round
        merges, in every fragment, its pair of least rank wherever it stands."""

        rank = np.full(len(ids), _NEVER)
        at = np.flatnonzero(joined)
        rank[at] = self._rank(ids[at], ids[at + 1])
        fragment = np.cumsum(np.append(True, ~joined[:-1])) - 1
        done: list[tuple[np.ndarray, ...]] = []
        while len(ids):
            heads = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1]))
            size = np.diff(np.append(heads, len(ids)))
            low = np.repeat(np.minimum.reduceat(rank, heads), size)
            over = low == _NEVER
            done.append((fragment[over], ids[over], owner[over]))
            ids, joined, owner, fragment, rank, low = (x[~over] for x in (ids, joined, owner, fragment, rank, low))
            at = np.flatnonzero(rank == low)
            if not len(at):
                break
            new = np.append(True, at[1:] != at[:-1] + 1)  # overlapping ones: every second from the left
            since = np.arange(len(at)) - np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
            at = at[since % 2 == 0]
            ids[at] = self.merge_ids[rank[at]]
            joined[at] = joined[at + 1]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids, joined, owner, fragment, rank = (x[keep] for x in (ids, joined, owner, fragment, rank))
            at -= np.arange(len(at))
            rank[at] = _NEVER
            change = np.zeros(len(ids), bool)
            change[at] = change[np.maximum(at, 1) - 1] = True
            change = np.flatnonzero(change & joined)
            rank[change] = self._rank(ids[change], ids[change + 1])
        fragment, ids, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(fragment, kind="stable")
        return ids[order], owner[order]

    def _simple_ids(self, raw: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words (bytes end to end, lengths) are simple, the ids of
        those end to end, and how many each of them has."""

        word = np.repeat(np.arange(len(length)), length)
        tail = (raw & 0xC0) == 0x80
        behind = np.append(np.uint8(0), raw[:-1])
        code = np.where(tail, (raw & 0x3F) | 0xC0, raw).astype(np.uint8)
        good = np.where(tail, (behind == 0xC3) & self.simple[code], (raw == 0xC3) | (raw < 0x80) & self.simple[raw])
        simple = np.logical_and.reduceat(good, np.cumsum(length) - length) & (length <= _SIMPLE_BYTES)
        mine = simple[word]
        raw, word, tail, code = raw[mine], word[mine], tail[mine], code[mine]
        if not len(raw):
            return simple, np.zeros(0, np.int32), np.zeros(0, np.int64)
        upper = np.where(tail, (code >= 0xC0) & (code <= 0xDE), (raw >= 65) & (raw <= 90))
        raw, code = raw + 32 * upper.astype(np.uint8), code + 32 * upper.astype(np.uint8)
        code = np.where(raw == 0xC3, np.append(code[1:], np.uint8(0)), code)  # a lead byte has its code point's
        ends = np.append(word[1:] != word[:-1], True)
        ends[:-1] |= ~tail[1:] & self.splits[code[:-1], code[1:]]
        ids = np.where(ends, self.byte_ids[1][raw], self.byte_ids[0][raw])
        letter = self.byte_codes[raw]
        joined = ~ends
        joined[:-1] &= self.pairs[letter[:-1], letter[1:]]  # forced boundaries
        flat, owner = self.merged(ids, joined, word)
        return simple, flat.astype(np.int32), np.bincount(owner, minlength=len(length))[simple]

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens, by the library."""

        if self.normalizer is not None:
            text = self.normalizer.normalize_str(text)
        return [p for p, _ in self.pre.pre_tokenize_str(text)] if self.pre is not None else [text] * bool(text)

    def _pieces_of(self, chunks: list[str]) -> list[list[str | int]]:
        """Pre-tokens, in byte letters, and special ids of each chunk."""

        out = []
        for chunk in chunks:
            found: list[str | int] = []
            for i, part in enumerate(self.special_cut.split(chunk) if self.special_cut else [chunk]):
                found += [self.special[part]] if i % 2 else self.pieces(part) if part else []
            out.append(found)
        return out

    def _plain_pieces_of(self, chunks: list[str]) -> list[list[str]]:
        """The same for plain chunks, all in one search; a piece that isn't
        ASCII is still to be put in byte letters."""

        out: list[list[str]] = []
        now: list[str] = []
        for piece in self.plain_pieces.findall("\n".join(chunks).lower() + "\n"):
            if piece == "\n":
                out.append(now)
                now = []
            else:
                now.append(piece)
        return out

    def fragments(self, pieces: list[str]) -> dict[str, list[str]]:
        """Pieces that hold a byte pair no token holds, cut there.  The pairs of
        all pieces are looked up at once; most pieces have no cut."""

        codes = np.frombuffer("".join(pieces).encode("utf-16-le"), np.uint16)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        cut = ~self.pairs[codes[:-1], codes[1:]]
        cut[ends[:-1] - 1] = False
        cuts = np.flatnonzero(cut) + 1
        owner = np.searchsorted(ends, cuts, "right")
        out: dict[str, list[str]] = {}
        at = np.append(np.flatnonzero(np.append(True, owner[1:] != owner[:-1])[: len(owner)]), len(owner))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            k = int(owner[a])
            p, start = pieces[k], int(ends[k]) - len(pieces[k])
            places = [0, *(cuts[a:b] - start).tolist(), len(p)]
            out[p] = [p[x:y] for x, y in zip(places, places[1:], strict=False)]
        return out

    @staticmethod
    def _ids(model, strings: list[str]) -> dict[str, bytes]:
        """Ids of each distinct string, from one library call a few thousand."""

        out: dict[str, bytes] = {}
        for a in range(0, len(strings), 20_000):
            some = strings[a : a + 20_000]
            found = model.encode(some, is_pretokenized=True, add_special_tokens=False)
            ends = (4 * np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(some)))).tolist()
            raw = array("i", found.ids).tobytes()
            out.update(zip(some, [raw[x:y] for x, y in zip([0, *ends], ends, strict=False)], strict=True))
        return out

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of each of the chunks, which are distinct."""

        plain: list[str] = []
        if self.plain_pieces is not None:
            plain = [c for c in chunks if _PLAIN.fullmatch(c)]
            if self.special_cut and self.special_cut.search("\n".join(plain)):
                plain = [c for c in plain if not self.special_cut.search(c)]
        ready = self._plain_pieces_of(plain) if plain else []
        known = set(plain)
        rest = [c for c in chunks if c not in known] if len(plain) < len(chunks) else []
        plans: list[list[str | int]] = [*ready, *self._pieces_of(rest)]
        # plain pieces are text, the others byte letters already
        coded = self.known_pieces
        text = {p for plan in ready for p in plan}
        if len(coded) + len(text) > PIECES:
            coded = self.known_pieces = {p: coded[p] for p in text if p in coded}
        letters = {p: p if p.isascii() else p.encode().decode("latin-1").translate(self.letter_of) for p in text if p not in coded}
        given = {p for plan in plans[len(plain) :] for p in plan if type(p) is str}
        pieces = list({*letters.values(), *given})
        cuts = self.fragments(pieces) if pieces else {}
        inner = self._ids(self.inner, list({f for parts in cuts.values() for f in parts[:-1]}))
        final = self._ids(self.final, list({cuts[p][-1] if p in cuts else p for p in pieces}))
        whole = {p: b"".join([*(inner[f] for f in parts[:-1]), final[parts[-1]]]) for p, parts in cuts.items()}
        coded.update((p, whole[x] if x in whole else final[x]) for p, x in letters.items())
        out = {c: coded[plan[0]] if len(plan) == 1 else b"".join([coded[p] for p in plan]) for c, plan in zip(plain, ready, strict=True)}
        for c, plan in zip(rest, plans[len(plain) :], strict=True):
            out[c] = b"".join([array("i", [p]).tobytes() if type(p) is int else whole[p] if p in whole else final[p] for p in plan])
        return [out[c] for c in chunks]

    def encode_buffer(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (UTF-8 bytes, offsets) end to end, and how many each has."""

        if self.drops_space:
            starts, ends = word_spans(buf, off, _DROPPED)
        else:
            has = np.diff(off) > 0
            starts, ends = off[:-1][has], off[1:][has]
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        hashes, checks = span_hashes(buf, starts, ends, _BYTE, _BYTE_OTHER)
        h, at, word = np.unique(hashes, return_index=True, return_inverse=True)
        check = checks[at]
        # words of one first hash but another second one (about one in 2**64): each by itself
        alone = np.flatnonzero(checks != check[word])
        if len(alone):
            word[alone] = len(h) + np.arange(len(alone))
            at = np.append(at, alone)
        first, count, parts, held = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), [], 0
        left = np.arange(len(at))
        for ids in (self.young, self.old):
            here = left[left < len(h)]
            known, place = ids.find(h[here], check[here])
            rows = here[known]
            first[rows], count[rows] = held + ids.starts[place], ids.counts[place]
            if ids is self.old and len(rows):  # still in use: young again
                self._keep(h[rows], check[rows], ids.counts[place], ragged(ids.flat, ids.starts[place], ids.counts[place].astype(np.int64)))
            parts.append(ids.flat)
            held += len(ids.flat)
            left = np.setdiff1d(left, rows, assume_unique=True)
        if len(left):
            new, count[left] = self.learn_spans(buf, starts[at[left]], ends[at[left]])
            first[left] = held + np.cumsum(count[left]) - count[left]
            parts.append(new)
            own = left < len(h)
            rows = left[own]
            self._keep(h[rows], check[rows], count[rows], new if own.all() else ragged(new, first[rows] - held, count[rows]))
        each = count[word]
        flat = ragged(np.concatenate(parts), first[word], each)
        before = np.zeros(len(word) + 1, np.int64)
        np.cumsum(each, out=before[1:])
        return flat, np.diff(before[np.searchsorted(starts, off)])

    def learn_spans(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of new words end to end, and how many each has: simple words side
        by side, the others through the library's components."""

        length = ends - starts
        counts = np.zeros(len(starts), np.int64)
        if self.simple is None:
            simple, flat = np.zeros(len(starts), bool), np.zeros(0, np.int32)
        else:
            simple, flat, some = self._simple_ids(ragged(buf, starts, length), length)
            counts[simple] = some
        texts = [buf[a:b].tobytes().decode() for a, b in zip(starts[~simple].tolist(), ends[~simple].tolist(), strict=True)]
        if not texts:
            return flat, counts
        distinct = list(dict.fromkeys(texts))
        by = dict(zip(distinct, self.learn(distinct), strict=True))
        found = [by[t] for t in texts]
        counts[~simple] = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.zeros(len(starts), np.int64)
        for k, base in ((simple, 0), (~simple, len(flat))):
            first[k] = base + np.cumsum(counts[k]) - counts[k]
        return ragged(np.append(flat, np.frombuffer(b"".join(found), np.int32)), first, counts), counts

    def _keep(self, h: np.ndarray, check: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        if len(self.young.h) + len(h) > CACHE or len(self.young.flat) + len(flat) > CACHE_IDS:
            self.old, self.young = self.young, WordIds()
        if len(h) <= CACHE and len(flat) <= CACHE_IDS:
            self.young = self.young.with_words(h, check, counts, flat)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""

        flat, counts = self.encode_buffer(*text_buffer(pa.array(texts, pa.large_string())))
        ends = np.cumsum(counts)
        return [flat[a:b].tobytes() for a, b in zip((ends - counts).tolist(), ends.tolist(), strict=True)]


_MADE: dict[str, ForcedBoundaryBPE] = {}


def encoder(spec: str) -> ForcedBoundaryBPE:
    """The worker's encoder: made once and kept, with its words, for the next task."""

    if spec not in _MADE:
        _MADE.clear()
        _MADE[spec] = ForcedBoundaryBPE(spec)
        gc.freeze()  # the vocabulary stays: the collector need not walk it again
    return _MADE[spec]


def read_spec(path: str) -> str:
    """The tokenizer's JSON (vocabulary file: its size doesn't depend on the corpus)."""

    with open(path, encoding="utf-8") as f:
        return f.read()


def _appended(df: DataFrame, fields: list[T.StructField], keep: list[str] | None) -> tuple[list[str], T.StructType]:
    new = {f.name.lower() for f in fields}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    return kept, T.StructType([df.schema[c] for c in kept] + fields)


def _encoding(spec: str, text: str, kept: list[str]):
    """Batches with the column ``text`` to batches of ``kept`` and ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(spec)
        for batch in batches:
            for i, j, buf, off in text_batches(batch, text, RUN):
                rows = batch.slice(i, j - i)
                flat, counts = bpe.encode_buffer(buf, off)
                at = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(counts, out=at[1:])
                ids = pa.ListArray.from_arrays(pa.array(at), pa.array(flat))
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), ids], [*kept, "ids"])

    return run


_NAMES: dict[str, tuple] = {}


def _names(spec: str) -> tuple:
    """The worker's decoder: tokens by id, and a pattern of the special ones."""

    if spec not in _NAMES:
        parsed = json.loads(spec)
        special_ids = {t["content"]: t["id"] for t in parsed.get("added_tokens", [])}
        special = re.compile("(" + "|".join(map(re.escape, sorted(special_ids, key=len, reverse=True))) + ")") if special_ids else None
        by_id = {i: t for t, i in [*parsed["model"]["vocab"].items(), *special_ids.items()]}
        _NAMES.clear()
        _NAMES[spec] = pa.array([by_id.get(i) for i in range(1 + max(by_id))], pa.large_string()), special, (parsed.get("decoder") or {}).get("type")
    return _NAMES[spec]


def _decoding(spec: str, ids: str, out: str, kept: list[str]):
    """Batches with the column ``ids`` to batches of ``kept`` and ``out``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, special, kind = _names(spec)
        byte_of = {c: b for b, c in enumerate(_byte_letters())}
        for batch in batches:
            lists = batch.column(ids)
            sizes = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            i = 0
            while i < batch.num_rows:
                j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + RUN // 4, "right")))
                rows = batch.slice(i, j - i)
                part = rows.column(ids)
                flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                known = (flat >= 0) & (flat < len(names))
                tokens = names.take(pa.array(np.where(known, flat, 0)))
                known &= tokens.is_valid().to_numpy(zero_copy_only=False)
                n = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
                at = np.zeros(len(n) + 1, np.int64)
                np.cumsum(np.add.reduceat(np.append(known, False), np.r_[0, np.cumsum(n)[:-1]].astype(np.int64)) * (n > 0), out=at[1:])
                lined = pa.LargeListArray.from_arrays(pa.array(at), tokens.filter(pa.array(known)))
                if kind is None:
                    texts = pc.binary_join(lined, pa.scalar(" ", pa.large_string())).cast(pa.string())
                else:
                    whole = pc.binary_join(lined, pa.scalar("", pa.large_string())).to_pylist()
                    texts = pa.array(
                        [
                            "".join(
                                p if special and k % 2 else bytes([byte_of[c] for c in p]).decode("utf-8", "replace")
                                for k, p in enumerate(special.split(t) if special else [t])
                            )
                            for t in whole
                        ]
                    )
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), texts], [*kept, out])
                i = j

    return run


def _checked(spec: str) -> str:
    kind = (json.loads(spec).get("decoder") or {}).get("type")
    if kind not in (None, "ByteLevel"):
        raise ValueError(f"no support for the decoder {kind}")
    return spec


_IDS = T.StructField("ids", T.ArrayType(T.IntegerType(), False), False)


def encode_documents(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids`` array<int>, the token
    ids of the column ``text``."""

    kept, schema = _appended(docs, [_IDS], keep)
    return docs.select(*dict.fromkeys([*(f"`{c}`" for c in kept), f"`{text}`"])).mapInArrow(_encoding(read_spec(tokenizer), text, kept), schema)


def decode_ids(df: DataFrame, tokenizer: str, ids: str = "ids", out: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``out``, the text of the ids:
    for a tokenizer without decoder its tokens joined by spaces, for the
    byte-level decoder the bytes its tokens stand for."""

    spec = _checked(read_spec(tokenizer))
    kept, schema = _appended(df, [T.StructField(out, T.StringType(), False)], keep)
    return df.select(*dict.fromkeys([*(f"`{c}`" for c in kept), f"`{ids}`"])).mapInArrow(_decoding(spec, ids, out, kept), schema)


def encode_and_decode(docs: DataFrame, tokenizer: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``ids`` and, decoded from them,
    ``decoded``: both in one Python worker a task."""

    spec = _checked(read_spec(tokenizer))
    kept, schema = _appended(docs, [_IDS, T.StructField("decoded", T.StringType(), False)], keep)
    encoded, decoded = _encoding(spec, text, kept), _decoding(spec, "ids", "decoded", [*kept, "ids"])
    return docs.select(*dict.fromkeys([*(f"`{c}`" for c in kept), f"`{text}`"])).mapInArrow(lambda batches: decoded(encoded(batches)), schema)
