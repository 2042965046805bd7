"""Token ids of many texts with a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a task remembers at once; older ones make way.
REMEMBERED = 200_000
#: The splitting rule of byte-level tokenizers (fixed value).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def open_tokenizer(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    out = Tokenizer.from_file(path)
    out.encode_special_tokens = True  # their strings in a text are ordinary text
    return out


def _byte_signs() -> dict[str, int]:
    """The visible character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _fast(path: str):
    """The same byte-level encoding with vocabulary ids as ranks; None for other kinds of file."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    split, model = rules.get("pre_tokenizer") or {}, rules["model"]
    same = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", ())]
    if not same or rules.get("normalizer") is not None or model.get("type", "BPE") != "BPE":
        return None
    made = [model["vocab"]["".join(m)] for m in merges]
    if made != sorted(set(made)) or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"):
        return None
    signs, special = _byte_signs(), {t["content"] for t in rules.get("added_tokens") or ()}
    ranks = {bytes(signs[c] for c in word): i for word, i in model["vocab"].items() if word not in special}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids, each as unsigned 32-bit little-endian numbers.

    With a byte-level vocabulary a space before a visible character always begins a new
    piece, so words are encoded independently: each distinct word is encoded once and its
    ids are remembered. A text with a space before other white space is encoded whole.
    """
    fast = _fast(path)
    if fast is None:
        slow = open_tokenizer(path)
        return lambda texts: [array("I", e.ids).tobytes() for e in slow.encode_batch_fast(texts, add_special_tokens=False)]
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}

    def ids_of(text: str) -> bytes:
        return array("I", fast.encode_ordinary(text)).tobytes()

    def word(part: str) -> bytes:
        ids = known.get(part)
        if ids is None:
            ids = known[part] = older.get(part) or ids_of(" " + part)
        return ids

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal known, older
        out = []
        for text in texts:
            first, *rest = text.split(" ")
            if any(not p or p[0].isspace() for p in rest):
                out.append(ids_of(text))
            else:
                out.append(ids_of(first) + b"".join(map(word, rest)))
            if len(known) > REMEMBERED:
                known, older = {}, known
        return out

    return encode


def vocabulary_size(path: str) -> int:
    """One more than the largest id of a tokenizer file, added tokens included."""
    return open_tokenizer(path).get_vocab_size(with_added_tokens=True)


#: What a tokenizer that drops white space does to a text before it looks at words (fixed values).
_DROPS_SPACE = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_ONLY_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


#: Words a task remembers before it begins anew; some hundred bytes each.
MOST_WORDS = 600_000
#: Characters below this are lower-cased and parted here as the library does it; others go through it.
_LATIN_END = "\u0250"


def _word_ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary of a tokenizer that encodes what stands between white space independently.

    A byte that no text has (255) stands for the end of a word, and words that end with it
    are ranked as the library merges them: last letters first, then in the order of merges,
    which is the order of ids. None if the file is of another kind.
    """
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    model, added = rules["model"], {t["content"] for t in rules.get("added_tokens") or ()}
    steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert")
    same = split and steps[0].get("pattern") == {"Regex": _ONLY_WORDS} and all(s.get("use_regex") is False for s in steps[1:])
    end, others = model.get("end_of_word_suffix"), (model.get("continuing_subword_prefix"), model.get("unk_token"), model.get("dropout"))
    if not same or (rules.get("normalizer") or {}).get("normalizers") != _DROPS_SPACE or not end or any(others):
        return None
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [model["vocab"]["".join(m)] for m in merges]
    signs = _byte_signs()
    ranks = {}
    for word, i in model["vocab"].items():
        if word not in added:
            ranks[bytes(signs[c] for c in word.removesuffix(end)) + (b"\xff" if word.endswith(end) else b"")] = i
    last = [i for word, i in ranks.items() if len(word) == 2 and word[1] == 255]
    ordered = made == sorted(set(made)) and len(last) == 256 and max(last) < min(made, default=1 << 31)
    return ranks if ordered and len(ranks) == len(model["vocab"]) - len(added & set(model["vocab"])) else None


def word_encoder(path: str, kind: str = "<u4") -> Callable[[pa.Array], pa.Array]:
    """A function from texts to their ids as numbers of a numpy ``kind``, for tokenizers that drop white space.

    What stands between ASCII white space is encoded independently, and so are the words
    and signs it consists of: the ids of both are remembered, up to a number of them. Words
    beyond the Latin scripts are encoded by the library; files of another kind, text by
    text.
    """
    slow = open_tokenizer(path)

    def whole(texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=kind).tobytes() for e in slow.encode_batch_fast(texts, add_special_tokens=False)]

    ranks = _word_ranks(path)
    if ranks is None:
        return lambda texts: pa.array(whole(texts.to_pylist()), pa.large_binary())
    import regex
    import tiktoken

    core, code = tiktoken.Encoding("words", pat_str=".", mergeable_ranks=ranks, special_tokens={})._core_bpe, "H" if np.dtype(kind).itemsize == 2 else "I"
    parts, piece_ids = regex.compile(_ONLY_WORDS).findall, core.encode_single_piece
    words: dict[str, bytes] = {}
    pieces: dict[str, bytes] = {}

    def piece(text: str) -> bytes:
        ids = pieces.get(text)
        if ids is None:
            ids = pieces[text] = array(code, piece_ids(text.encode() + b"\xff")).tobytes()
        return ids

    def learn(fresh: list[str]) -> None:
        joined = " ".join(fresh)
        latin = joined.isascii() or max(joined) < _LATIN_END
        # Within the Latin scripts a letter's lower case does not depend on its neighbours.
        plain = unicodedata.normalize("NFC", joined).lower().split(" ") if latin else [None] * len(fresh)
        for raw, text in zip(fresh, plain, strict=True):
            if text is None:
                if max(raw, default="") >= _LATIN_END:
                    words[raw] = whole([raw])[0]
                    continue
                text = unicodedata.normalize("NFC", raw).lower()
            # A word of letters alone is one piece.
            words[raw] = piece(text) if text.isalpha() else b"".join(map(piece, parts(text)))

    def encode(texts: pa.Array) -> pa.Array:
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        coded = split.flatten().dictionary_encode()
        own = coded.dictionary.to_pylist()
        for known in (words, pieces):
            if len(known) > MOST_WORDS:
                known.clear()
        if fresh := [w for w in own if w not in words]:
            learn(fresh)
        # Each distinct word is looked up once; its ids are copied to wherever it stands.
        ids = pa.array([words[w] for w in own], pa.large_binary()).take(coded.indices)
        first = split.offsets.to_numpy()
        at = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1)[first - first[0]]
        data = ids.buffers()[2]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(texts), [None, pa.py_buffer(at), pa.py_buffer(b"") if data is None else data]
        )

    return encode
