"""Byte-pair encoding by the vocabulary of a tokenizer file, faster than the file's own library.

Where merges stand in the order of their ids, merging by ids gives the library's tokens. That is
checked when a file is read; any other file, and any text that this path isn't made for, goes
through the library itself.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np

#: Stands for the end of a word in vocabularies that mark it. No letter has this byte.
WORD_END = "\x01"
#: How byte-level splitting cuts texts; a fixed value of that scheme.
BYTE_LEVEL = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_of_letter() -> dict[str, int]:
    """Vocabularies write a byte as its Latin-1 character if that is visible, else as one from U+0100 on."""
    visible = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace()]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


def ranks(file: dict) -> dict[bytes, int] | None:
    """Ids by the bytes of their tokens; None if merging by ids might differ from the file's merges."""
    model, extra = file["model"], {t["id"] for t in file["added_tokens"]}
    mark, letters = model.get("end_of_word_suffix") or "", _byte_of_letter()
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "byte_fallback", "continuing_subword_prefix", "ignore_merges")):
        return None
    vocabulary = model["vocab"]

    def joined(a: str, b: str) -> str:
        return (a[: -len(mark)] if mark and a.endswith(mark) else a) + b

    ids = [vocabulary.get(joined(a, b)) for a, b in merges]
    single = len(vocabulary) - len(set(ids)) - len(extra & set(vocabulary.values()))
    if None in ids or any(x >= y for x, y in zip(ids, ids[1:])) or ids and ids[0] < single:
        return None
    out = {}
    for token, number in vocabulary.items():
        if number in extra:
            continue
        ended = bool(mark) and token.endswith(mark) and token != mark
        letters_of = token[: -len(mark)] if ended else token
        if any(c not in letters for c in letters_of):
            return None
        out[bytes(letters[c] for c in letters_of) + WORD_END.encode() * ended] = number
    return out


class ByteEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit numbers, for byte-level files."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.library, self.fast = library(path), None
        split, table = file.get("pre_tokenizer") or {}, ranks(file)
        self.extra = [t["content"] for t in file["added_tokens"]]
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        if plain and table and not file.get("normalizer") and not file.get("truncation"):
            import tiktoken

            self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=BYTE_LEVEL, mergeable_ranks=table,
                                          special_tokens={})

    def encode(self, text: str | None) -> bytes:
        text = text or ""
        if self.fast and not any(t in text for t in self.extra):
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        else:
            ids = self.library.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


class WordEncoder:
    """Token ids of single words, for files that mark word ends, lower-case, and part runs of letters."""

    #: Letters from here on go through the library, whose Unicode version may be another.
    LAST = "\u0530"

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        self.library, self.fast = library(path), None
        table = ranks(file) if file["model"].get("end_of_word_suffix") else None
        steps = [n.get("type") for n in (file.get("normalizer") or {}).get("normalizers", [])]
        if table and steps == ["NFC", "Replace", "Lowercase"] and "[\\p{L}]+" in json.dumps(file["pre_tokenizer"]).replace("\\\\", "\\"):
            import tiktoken

            self.fast = tiktoken.Encoding(os.path.basename(path), pat_str=f"[^{WORD_END}]+{WORD_END}", mergeable_ranks=table,
                                          special_tokens={})
            self.ends = np.zeros(max(table.values()) + 1, bool)
            self.ends[[n for token, n in table.items() if token.endswith(WORD_END.encode()) and len(token) > 1]] = True

    def plain(self, word: str) -> bool:
        """Whether a word is letters that normalisation leaves as they are but for their case."""
        return bool(self.fast) and word.isalpha() and (word.isascii() or (
            max(word) < self.LAST and "\u03a3" not in word and unicodedata.is_normalized("NFC", word) and word.lower().isalpha()))

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word as little-endian unsigned 32-bit numbers."""
        plain = [w for w in words if self.plain(w)]
        out = {}
        if plain:
            ids = self.fast.encode_to_numpy("".join(w.lower() + WORD_END for w in plain), disallowed_special=()).astype("<u4")
            data, at = ids.tobytes(), 0
            for word, end in zip(plain, (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()):
                out[word], at = data[at:end], end
        rest = words if len(plain) == 0 else [w for w in words if w not in out]
        for word, found in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            out[word] = np.array(found.ids, "<u4").tobytes()
        return out
