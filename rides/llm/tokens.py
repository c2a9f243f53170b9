"""Token ids of whole texts by the ``tokenizers`` library, inside tasks.

Texts of a corpus repeat their words, and for a tokenizer that drops white
space the ids of a text are those of its blank-separated chunks in order. Such
a tokenizer encodes each distinct chunk once per worker and the ids of a text
are joined from a table of chunks; any other one encodes whole texts. The table
goes when the worker comes to a stage other than the one that filled it.
"""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from operator import add

END_ID = 2
# Entries of a worker's chunk table; a full table starts again empty, which
# changes nothing but the time.
CHUNKS = 800_000
MARKS = ".,!?;:#$%&*)"

_ENCODERS: dict[str, "Encoder"] = {}
_STAGE: int | None = None


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file (kept between tasks)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def forget(stage: int) -> bool:
    """Drop the chunk tables of a stage before this one, and whether there were
    any; encoders stay."""
    global _STAGE
    before, _STAGE = _STAGE, stage
    if before == stage or not _ENCODERS:
        return False
    for kept in _ENCODERS.values():
        kept.table = {"": b""}
    return True


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in byte order."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) if b in kept else chr(256 + n)
            for b, n in ((b, sum(x not in kept for x in range(b))) for b in range(256))}


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_chunk = self._drops_space(spec)
        self.words, self.marks = None, ""
        if self.by_chunk and spec["model"].get("end_of_word_suffix"):
            self._word_model(spec)
        self.table: dict[str, bytes] = {"": b""}

    @staticmethod
    def _drops_space(spec: dict) -> bool:
        norm = spec.get("normalizer") or {}
        pre = spec.get("pre_tokenizer") or {}
        steps = [n.get("type") for n in norm.get("normalizers", [])]
        splits = [p for p in pre.get("pretokenizers", []) if p.get("type") == "Split"]
        return (steps == ["NFC", "Replace", "Lowercase"] and len(splits) == 1
                and splits[0]["behavior"] == "Removed" and splits[0]["invert"]
                and "[\\p{L}]+" in splits[0]["pattern"].get("Regex", "").split("|"))

    def _word_model(self, spec: dict) -> None:
        """The same model behind a plain newline split, for words that
        normalization leaves alone and that are one pre-token."""
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        # Marks behind a word are one pre-token of their own where the pattern
        # has a run of them, and where they occur in no added token.
        patterns = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        added = "".join(t["content"] for t in spec.get("added_tokens", []))
        if r"[^\s\p{L}\p{N}]+" in patterns[0].split("|"):
            self.marks = "".join(m for m in MARKS if m not in added)
        suffix = spec["model"]["end_of_word_suffix"]
        self.words = Tokenizer(self.full.model)
        self.words.pre_tokenizer = pre_tokenizers.Split("\n", "removed")
        self.letters = _byte_letters()
        self.ends = np.zeros(self.full.get_vocab_size(with_added_tokens=True) + 1, bool)
        for token, i in spec["model"]["vocab"].items():
            self.ends[i] = token.endswith(suffix)

    def _encode_words(self, words: list[str]) -> None:
        """Table entries of lower-case words of letters."""
        import numpy as np

        for i in range(0, len(words), 2000):
            part = words[i:i + 2000]
            text = "\n".join([w if w.isascii() else
                              w.encode().decode("latin-1").translate(self.letters) for w in part])
            ids = np.array(self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or (len(stops) and stops[-1] != len(ids)):
                self._encode_chunks(part)
                continue
            raw, ends = ids.tobytes(), (stops * 4).tolist()
            self.table.update(zip(part, map(raw.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))

    def _encode_chunks(self, chunks: list[str]) -> None:
        for i in range(0, len(chunks), 5000):
            part = chunks[i:i + 5000]
            for c, e in zip(part, self.full.encode_batch_fast(part, add_special_tokens=False)):
                self.table[c] = array("I", e.ids).tobytes()

    def _learn(self, chunks: set[str]) -> None:
        """Table entries of new chunks. A chunk of letters, with or without
        marks behind it, is put together from its word and the marks."""
        table, marks, plain, other = self.table, self.marks, set(), []
        made, lows, tails = [], [], []      # chunks to put together, their words and marks
        if self.words is None:
            return self._encode_chunks(list(chunks))
        for c in chunks:
            core = c if c.isalpha() else c.rstrip(marks)
            if core.isascii():
                low, fits = core.lower(), core.isalpha()
            else:
                # The library lowers each character by itself; str.lower() turns a
                # word's last capital sigma into the final form.
                low = "".join(map(str.lower, core)) if "\u03a3" in core else core.lower()
                fits = low.isalpha() and (low.isascii() or unicodedata.is_normalized("NFC", core))
            if not fits:
                other.append(c)
                continue
            if low not in table:
                plain.add(low)
            if low != c:
                made.append(c)
                lows.append(low)
                tails.append(c[len(core):])
        other.extend(set(tails).difference(table, other))
        self._encode_words(list(plain))
        self._encode_chunks(other)
        get = table.__getitem__
        table.update(zip(made, map(add, map(get, lows), map(get, tails)), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian unsigned 32-bit."""
        if not self.by_chunk:
            return [array("I", e.ids).tobytes()
                    for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]
        split = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.table) > CHUNKS:
            self.table = {"": b""}
        # One look at the table a chunk; only what it lacks is looked up again.
        get, parts, gaps, new = self.table.get, [], [], set()
        for words in split:
            found = list(map(get, words))
            try:
                parts.append(b"".join(found))
            except TypeError:       # a None among them
                lacks = [i for i, ids in enumerate(found) if ids is None]
                new.update([words[i] for i in lacks])
                gaps.append((len(parts), words, found, lacks))
                parts.append(b"")
        if new:
            self._learn(new)
        for at, words, found, lacks in gaps:
            for i in lacks:
                found[i] = self.table[words[i]]
            parts[at] = b"".join(found)
        return parts


def encode_documents(texts: list, path: str, end_id: int = END_ID) -> list[bytes]:
    """Ids of each text (null: empty) followed by the end id."""
    end = array("I", [end_id]).tobytes()
    return [x + end for x in encoder(path).encode([t or "" for t in texts])]
