"""Token ids of whole texts with a ``tokenizers`` file, each distinct word encoded once.

A tokenizer whose normaliser folds white space and whose pre-tokenizer drops
it never joins characters across white space, so the ids of a text are the
ids of its white-space-separated chunks put end to end.  Chunks repeat
heavily; a batch is split and dictionary-encoded by Arrow, ids are looked up
per distinct chunk, and the text's ids are gathered by numpy.  Chunks of
other alphabets, texts holding a special token's string, and tokenizers that
are built otherwise go to the library as they are.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: chunks in which the normaliser does no more than lower-case ASCII letters
PLAIN = regex.compile("[!-~ß-öø-ÿ]+")
MEMORY = 400_000  # chunks and words remembered by a worker


def _byte_symbols() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 stands for itself, the rest follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


SYMBOL = _byte_symbols()


def word_pattern(spec: dict) -> str | None:
    """The word pattern of a tokenizer that lower-cases and drops white space, else None."""
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    if [s.get("type") for s in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["content"] != " ":
        return None
    if [p.get("type") for p in parts] != ["Split", "ByteLevel"] or spec.get("post_processor"):
        return None
    split, level = parts
    if not split["invert"] or split["behavior"] != "Removed" or level["use_regex"] or level["add_prefix_space"]:
        return None
    return split["pattern"].get("Regex")


class WordEncoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_padding()
        self.tok.no_truncation()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pattern = word_pattern(spec)
        self.words = regex.compile(pattern) if pattern else None
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.model = self.tok.model
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype=np.uint32)
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece(self, word: str) -> bytes:
        got = self.pieces.get(word)
        if got is None:
            symbols = word if word.isascii() else "".join(SYMBOL[b] for b in word.encode())
            got = np.array([t.id for t in self.model.tokenize(symbols)], dtype=np.uint32).tobytes()
            self.pieces[word] = got
        return got

    def _chunk_ids(self, chunks: list[str]) -> list[bytes]:
        if len(self.chunks) > MEMORY:
            self.chunks.clear()
        if len(self.pieces) > MEMORY:
            self.pieces.clear()
        out = [self.chunks.get(c) for c in chunks]
        odd = []
        for i, got in enumerate(out):
            if got is None:
                c = chunks[i]
                if not c:
                    out[i] = b""
                elif PLAIN.fullmatch(c):
                    words = self.words.findall(c)
                    out[i] = self._piece(words[0]) if len(words) == 1 else b"".join(map(self._piece, words))
                    if len(c) < 40:
                        self.chunks[c] = out[i]
                else:
                    odd.append(i)
        if odd:
            for i, ids in zip(odd, self._library([chunks[i] for i in odd])):
                out[i] = ids.tobytes()
                if len(chunks[i]) < 40:
                    self.chunks[chunks[i]] = out[i]
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids end to end, number of ids per text) of non-null texts."""
        if len(texts) == 0:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        whole = np.ones(len(texts), bool)
        if self.words:
            whole[:] = False
            for s in self.special:  # also in other letter case: lower-casing must not make one
                whole |= pc.match_substring(texts, s, ignore_case=True).to_numpy(zero_copy_only=False)
        if whole.any():
            parts: list[np.ndarray] = [None] * len(texts)
            rest = np.flatnonzero(~whole)
            for i, ids in zip(np.flatnonzero(whole), self._library(texts.filter(pa.array(whole)).to_pylist())):
                parts[i] = ids
            if len(rest):
                ids, n = self.encode(texts.take(pa.array(rest)))
                for i, part in zip(rest, np.split(ids, np.cumsum(n)[:-1])):
                    parts[i] = part
            return np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        at = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        if isinstance(coded, pa.ChunkedArray):
            coded = coded.combine_chunks()
        held = self._chunk_ids(coded.dictionary.to_pylist())
        # places in a slice's ids fit 32 bits: an Arrow array holds less than 2 GB of text, and an id a byte at least
        size = (np.fromiter(map(len, held), np.int64, len(held)) // 4).astype(np.int32)
        flat = np.frombuffer(b"".join(held), np.uint32)
        del held
        codes = coded.indices.to_numpy()
        lens = size[codes]
        ends = np.cumsum(lens, dtype=np.int32)
        first = (np.cumsum(size, dtype=np.int32) - size)[codes]
        first -= ends
        first += lens
        place = np.arange(ends[-1] if len(ends) else 0)
        place += np.repeat(first, lens)
        del first, lens
        ids = flat[place]
        del place
        upto = np.concatenate([np.zeros(1, np.int32), ends])
        at = at - at[0]
        return ids, np.diff(upto[at]).astype(np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file; what it remembers outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
