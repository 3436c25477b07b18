"""BPE encoding by prefix-sharing trie traversal (operator 4).

Distinct words are visited in sorted order, which is a depth-first walk of
their trie: the stack holds, for every prefix of the current word, the last
token of that prefix's encoding, and the next word keeps the states of the
prefix it shares. The last token of a longer prefix is the one vocabulary
token that ends it and may follow the last token of what stands before it, so
a state costs a few dictionary look-ups, and a word's tokens are read
backwards from its last state. Two tokens may stand side by side when no merge
across their border would have come first.

Texts are mapped in Arrow batches; nothing is shuffled. A worker remembers a
bounded number of space-delimited chunks and of token pairs.

Defined cases: a null or empty text has no ids and decodes to ''; strings of
the added tokens become their ids, as in the library; repeated rows are
encoded each; other columns are dropped, so none can clash.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Chunks a worker remembers, and texts that share one trie.
REMEMBER, TRIE_TEXTS = 150_000, 1000
SCHEMA = "ids_le binary, decoded string"


def _byte_symbols() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes (byte-level BPE): printable Latin-1
    stands for itself, the others follow from U+0100 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in kept}
    out.update({b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in out)})
    return out


class TrieBpe:
    """Encoder of one tokenizers file with an end-of-word suffix."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.text_of = {i: t for t, i in self.vocab.items()}
        self.merge = {}
        self.split = {}
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a_id, b_id, made = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.merge.setdefault((a_id, b_id), (rank, made))
            self.split.setdefault(made, (a_id, b_id, rank))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.text_of.update({i: t for t, i in self.added.items()})
        self.added_re = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.library = Tokenizer.from_file(path)
        self.plain_re = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
        self.is_plain = re.compile(r"[!-~À-ÖØ-öø-ÿ]+").fullmatch
        self.bytes_as = _byte_symbols()
        self.fits: dict[int, bool] = {}
        # of chunks between spaces, and of words: packed ids and decoded string
        self.ids, self.texts, self.old_ids, self.old_texts, self.known, self.silent = {}, {}, {}, {}, {}, False
        # tokens whose own string encodes to them, by their string without the suffix
        self.inner, self.final, cut = {}, {}, len(self.end)
        for t, i in self.vocab.items():
            ends = t.endswith(self.end)
            bare = t[:-cut] if ends else t
            if len(bare) == 1 or self.plain(self.symbols(bare, ends)) == [i]:
                (self.final if ends else self.inner)[bare] = i
        self.starts = {t[:k] for d in (self.inner, self.final) for t in d for k in range(1, len(t) + 1)}

    def plain(self, symbols: list[int]) -> list[int]:
        """Merges in order of rank, leftmost first: the definition of BPE."""
        ids, left, right = list(symbols), [*range(-1, len(symbols) - 1)], [*range(1, len(symbols) + 1)]
        heap = [(*self.merge[p], i) for i in range(len(ids) - 1) if (p := (ids[i], ids[i + 1])) in self.merge]
        heap = [(rank, i, made) for rank, made, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = right[i] if ids[i] is not None else len(ids)
            if j >= len(ids) or self.merge.get((ids[i], ids[j])) != (rank, made):
                continue
            ids[i], ids[j] = made, None
            right[i] = right[j]
            if right[i] < len(ids):
                left[right[i]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b < len(ids) and (m := self.merge.get((ids[a], ids[b]))):
                    heapq.heappush(heap, (m[0], a, m[1]))
        return [x for x in ids if x is not None]

    def symbols(self, token: str, ends: bool) -> list[int]:
        return [self.vocab[c] for c in token[:-1]] + [self.vocab[token[-1] + self.end * ends]]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether encoding the strings of ``a`` and ``b`` in a row gives [a, b]."""
        if len(self.fits) > 300_000:
            self.fits.clear()
        got = self.fits[a << 20 | b] = self._no_merge_between(a, b)
        return got

    def _no_merge_between(self, a: int, b: int) -> bool:
        # Undo the two sides from their latest merge back. While a side stood
        # as it does now, the merge that ended its stay has rank ``until``; a
        # border merge that comes before both of those would have been made;
        # of merges of equal rank the leftmost comes first.
        until_a = until_b = float("inf")
        while True:
            joined = self.merge.get((a, b))
            if joined is not None and joined[0] < until_a and joined[0] <= until_b:
                return False
            sa, sb = self.split.get(a), self.split.get(b)
            if sa is None and sb is None:
                return True
            if sb is None or (sa is not None and sa[2] > sb[2]):
                until_a, a = sa[2], sa[1]
            else:
                until_b, b = sb[2], sb[0]

    def words(self, sorted_words: list[str]) -> dict[str, list[int]]:
        """Token ids of distinct byte-symbol words given in sorted order."""
        out, before = {}, ""
        inner, final, starts, follow, fits = self.inner.get, self.final.get, self.starts, self.may_follow, self.fits.get
        last: list[int] = [-1]  # last[i]: last token of the first i symbols
        size: list[int] = [0]
        reach: list[int] = [0]  # longest end of those symbols that some token starts with
        for word in sorted_words:
            n = len(word)
            shared, most = 0, min(len(before), n - 1, len(last) - 1)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del last[shared + 1:], size[shared + 1:], reach[shared + 1:]
            for i in range(shared + 1, n):
                k = reach[i - 1] + 1
                while word[i - k:i] not in starts:
                    k -= 1
                reach.append(k)
                while True:
                    t = inner(word[i - k:i])
                    if t is not None:
                        if k == i:
                            break
                        ok = fits(last[i - k] << 20 | t)
                        if ok or ok is None and follow(last[i - k], t):
                            break
                    k -= 1
                last.append(t)
                size.append(k)
            k = reach[n - 1] + 1
            while True:
                t = final(word[n - k:])
                if t is not None:
                    if k == n:
                        break
                    ok = fits(last[n - k] << 20 | t)
                    if ok or ok is None and follow(last[n - k], t):
                        break
                k -= 1
            ids, i = [t], n - k
            while i:
                ids.append(last[i])
                i -= size[i]
            ids.reverse()
            out[word] = ids
            before = word
        return out

    def pieces(self, chunk: str) -> list:
        """Words of a chunk as byte symbols; added tokens as their ids."""
        if "<|" in chunk:
            out = []
            for part in self.added_re.split(chunk):
                out.extend([self.added[part]] if part in self.added else self.pieces_plain(part))
            return out
        return self.pieces_plain(chunk)

    def pieces_plain(self, chunk: str) -> list[str]:
        # ASCII and composed Latin-1 letters: nothing to normalise but the case
        if self.is_plain(chunk):
            words = self.plain_re.findall(chunk.lower())
            return words if chunk.isascii() else [w.encode().decode("latin-1").translate(self.bytes_as) for w in words]
        return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))]

    def encode_texts(self, texts: list) -> list[tuple[bytes, str]]:
        """Packed ids and decoded string of each text."""
        rows = [[c for c in (t or "").replace("\n", " ").split(" ") if c] for t in texts]
        ids_of, text_of, name = self.ids, self.texts, self.text_of
        new, fresh = {}, set()
        for c in set().union(*rows):
            if c not in ids_of:
                if c in self.old_ids:
                    ids_of[c], text_of[c] = self.old_ids[c], self.old_texts[c]
                else:
                    new[c] = ps = self.pieces(c)
                    fresh.update(ps)
        words = {p for p in fresh if isinstance(p, str) and p not in self.known}
        got = self.words(sorted(words))
        for w, ids in got.items():
            self.known[w] = (struct.pack(f"<{len(ids)}I", *ids), " ".join([name[i] for i in ids]))
        for c, ps in new.items():
            parts = [self.known[p] if isinstance(p, str) else (struct.pack("<I", p), name[p]) for p in ps]
            ids_of[c], text_of[c] = parts[0] if len(parts) == 1 else (
                b"".join([p[0] for p in parts]), " ".join([p[1] for p in parts]))
        silent = any(not text_of[c] for c in new) or self.silent
        self.silent = silent
        out = []
        for r in rows:
            if silent:
                r = [c for c in r if ids_of[c]]
            out.append((b"".join(map(ids_of.__getitem__, r)), " ".join(map(text_of.__getitem__, r))))
        if len(ids_of) > REMEMBER:  # the older half goes
            self.old_ids, self.old_texts, self.ids, self.texts = ids_of, text_of, {}, {}
        if len(self.known) > REMEMBER:
            self.known = {}
        return out


_encoders: dict[str, TrieBpe] = {}


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, ids_le, decoded)``: token ids packed as little-endian unsigned
    32-bit integers, and the text that decoding them gives."""
    d = docs.select(id_col, text_col)
    kind = d.schema[0]

    def run(batches):
        gc.disable()  # many small lists and no cycles: counting references frees all
        try:
            for batch in batches:
                enc = _encoders.get(path) or _encoders.setdefault(path, TrieBpe(path))
                for i in range(0, batch.num_rows, TRIE_TEXTS):
                    part = batch.slice(i, TRIE_TEXTS)
                    got = enc.encode_texts(part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())],
                        names=[id_col, "ids_le", "decoded"])
        finally:
            gc.enable()

    return d.mapInArrow(run, f"`{id_col}` {kind.dataType.simpleString()}, {SCHEMA}")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token count and SHA-256 of ids and decoded text of ``encode``'s rows."""
    return encoded.select(id_col, (F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids_le", 256).alias("ids_sha256"),
                          F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
