"""Token ids of a byte-level BPE vocabulary file.

The file is read in the JSON format of the ``tokenizers`` library. Its ids are made with ``tiktoken``,
which gives the same ids at about a quarter of the time wherever the ids follow the order of the merges
(checked on loading); for other files, and for texts with a run of white space that ``tiktoken`` cannot
match, ``tokenizers`` itself is used. An added token of the file is
matched wherever its string stands in a text, as ``tokenizers`` does; none is put around a text.
"""

from __future__ import annotations

import json
from functools import lru_cache

# Fixed value: how byte-level BPE cuts a text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _letters() -> dict[str, int]:
    """The printable character that stands for each byte in a vocabulary file, to its byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to the list of its ids, without tokens that are not in the text."""
    spec = json.load(open(path, encoding="utf-8"))
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", ())]
    added = {t["content"]: t for t in spec.get("added_tokens") or ()}
    # Added tokens are cut out first; both libraries agree on where if there is one way to match them.
    exact = (
        not any(t.get(k) for t in added.values() for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and all(added)
        and not any(a != b and a in b for a in added for b in added)
        and not any(c in vocab for c in added)
        and {t["id"] for t in added.values()}.isdisjoint(vocab.values())
    )
    ordered = (
        exact
        and model.get("type") == "BPE"
        and spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", False)
        and len(vocab) == 256 + len(merges)
        and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
    )
    if ordered:
        import tiktoken

        letters = _letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items()}
        special = {content: t["id"] for content, t in added.items()}
        encoding = tiktoken.Encoding(path, pat_str=PIECES, mergeable_ranks=ranks, special_tokens=special)

        def encode(text: str) -> list[int]:
            try:
                return encoding.encode(text, allowed_special="all")
            except ValueError:  # its pattern gives up on runs of white space that are too long for it
                return _reference(path)(text)

        return encode
    return _reference(path)


@lru_cache(maxsize=2)
def _reference(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids
