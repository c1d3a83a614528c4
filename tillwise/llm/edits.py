"""Token counts that follow edits: only what an edit touches is encoded again.

A document is kept as leaves, each a word with the white space after it, its bytes and its number of tokens. Leaves lie in
blocks, and a binary tree over the blocks holds the sums of bytes and tokens of every subtree. An edit (place, bytes taken
out, bytes put in) descends by byte sums to the leaves it touches; these and one leaf on either side, with which the new text
may grow together, are split and encoded again, and the sums above are brought up to date. The tokenizer never merges
across white space, so the count always is that of the whole edited text.

Edits of a document apply one after the other, each to the text the ones before it left. Places beyond the end are at the end.
Nulls: a null text is empty, null edits are none, an edit with a null part is left out; a null id stays null. Repeated rows
are documents of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.column import Column

from tillwise.llm.shipping import ship, whole
from tillwise.llm.wordids import WordEncoder, encoder
from tillwise.session import tune

BLOCK = 64  # leaves in a block

_LEAF = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+")

EDITS = "array<struct<place: long, removed: long, added: binary>>"


class CountTree:
    """A document's leaves in blocks, and a tree of their sums."""

    def __init__(self, text: bytes, encode: WordEncoder, known: list[int] | None = None):
        """``known``: tokens per leaf, as ``leaf_tokens`` gave them; then nothing is encoded."""
        self._encode = encode
        self.encoded = 0  # leaves encoded after the first count
        leaves = _LEAF.findall(text)
        tokens = encode.word_counts(text.split()).tolist() if known is None else list(known)
        tokens = [0] * (len(leaves) - len(tokens)) + tokens  # white space at the beginning is a leaf
        self._leaves = [leaves[i : i + BLOCK] for i in range(0, len(leaves), BLOCK)] or [[]]
        self._tokens_of = [tokens[i : i + BLOCK] for i in range(0, len(tokens), BLOCK)] or [[]]
        self._build()

    def _tokens(self, leaves: list[bytes]) -> list[int]:
        words = [leaf.rstrip(b" \t\n\r\x0b\x0c") for leaf in leaves]
        counts = iter(self._encode.word_counts([word for word in words if word]).tolist())
        return [next(counts) if word else 0 for word in words]

    def _build(self) -> None:
        self._width = 1 << max(0, len(self._leaves) - 1).bit_length()
        sums = [(sum(map(len, leaves)), sum(tokens)) for leaves, tokens in zip(self._leaves, self._tokens_of)]
        sums += [(0, 0)] * (self._width - len(sums))
        self._sums = [(0, 0)] * self._width + sums
        for node in range(self._width - 1, 0, -1):
            (a, b), (c, d) = self._sums[2 * node], self._sums[2 * node + 1]
            self._sums[node] = (a + c, b + d)

    def _update(self, block: int) -> None:
        node = self._width + block
        self._sums[node] = (sum(map(len, self._leaves[block])), sum(self._tokens_of[block]))
        node //= 2
        while node:
            (a, b), (c, d) = self._sums[2 * node], self._sums[2 * node + 1]
            self._sums[node] = (a + c, b + d)
            node //= 2

    @property
    def bytes(self) -> int:
        return self._sums[1][0]

    @property
    def tokens(self) -> int:
        return self._sums[1][1]

    def text(self) -> bytes:
        return b"".join(leaf for leaves in self._leaves for leaf in leaves)

    def leaf_tokens(self) -> list[int]:
        return [n for tokens in self._tokens_of for n in tokens]

    def _find(self, place: int) -> tuple[int, int]:
        """The block that holds the byte at ``place`` (the last one at the end) and the bytes before it."""
        node, before = 1, 0
        while node < self._width:
            node *= 2
            if before + self._sums[node][0] <= place and self._sums[node + 1][0]:
                before += self._sums[node][0]
                node += 1
        return min(node - self._width, len(self._leaves) - 1), before

    def edit(self, place: int, removed: int, added: bytes) -> None:
        """Take ``removed`` bytes out at ``place`` and put ``added`` there."""
        place = min(max(place, 0), self.bytes)
        last = min(place + max(removed, 0), self.bytes)
        first_block, before = self._find(max(place - 1, 0))
        last_block, _ = self._find(min(last, max(self.bytes - 1, 0)))
        leaves = [leaf for block in self._leaves[first_block : last_block + 1] for leaf in block]
        tokens = [n for block in self._tokens_of[first_block : last_block + 1] for n in block]
        ends = np.cumsum(np.fromiter(map(len, leaves), np.int64, len(leaves)))
        # the leaves touched, from the one that ends at the place to the one that begins at the end of the cut
        low = int(np.searchsorted(ends, place - before)) if leaves else 0
        high = min(int(np.searchsorted(ends, last - before, side="right")) + 1, len(leaves))
        start = before + (int(ends[low - 1]) if low else 0)
        region = b"".join(leaves[low:high])
        new = _LEAF.findall(region[: place - start] + added + region[last - start :])
        # white space that now stands first belongs to the leaf before
        if new and low and not new[0].strip(b" \t\n\r\x0b\x0c"):
            low -= 1
            new[:1] = [leaves[low] + new[0]]
        self.encoded += len(new)
        leaves[low:high], tokens[low:high] = new, self._tokens(new)
        self._leaves[first_block], self._tokens_of[first_block] = leaves, tokens
        for block in range(first_block + 1, last_block + 1):
            self._leaves[block], self._tokens_of[block] = [], []
        if len(leaves) > 4 * BLOCK:
            flat = [leaf for block in self._leaves for leaf in block], [n for block in self._tokens_of for n in block]
            self._leaves, self._tokens_of = ([x[i : i + BLOCK] for i in range(0, len(x), BLOCK)] for x in flat)
            self._build()
        else:
            for block in range(first_block, last_block + 1):
                self._update(block)


def _counted(path: str, find: Callable[[bytes], list[tuple[int, int, bytes]]] | None, keep: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            given = batch.column("edits") if find is None else [None] * batch.num_rows
            known = batch.column("leaves") if "leaves" in batch.schema.names else [None] * batch.num_rows
            rows, texts, leaves = [], [], []
            for value, many, tokens in zip(batch.column("text"), given, known):
                text = value.as_py()
                if find is None:
                    some = [tuple(edit.values()) for edit in many.as_py() or () if edit is not None and None not in edit.values()]
                else:
                    some = find(text)
                tree = CountTree(text, encode, tokens.as_py() if tokens is not None else None)
                before = tree.tokens
                for edit in some:
                    tree.edit(*edit)
                rows.append((before, tree.tokens, len(some), tree.encoded))
                if keep:
                    texts.append(tree.text())
                    leaves.append(tree.leaf_tokens())
            columns = [pa.array(column, pa.int64()) for column in zip(*rows)] or [pa.array([], pa.int64())] * 4
            kept = [pa.array(texts, pa.binary()), pa.array(leaves, pa.list_(pa.int32()))] if keep else []
            names = ["doc_id", "n_tokens", "n_tokens_edited", "n_edits", "n_encoded_again", "utf8", "leaves"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, *kept], names[: 5 + len(kept)])

    return run


def edited_counts(
    docs: DataFrame, edits: Column | Callable[[bytes], list[tuple[int, int, bytes]]], tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    leaves: str | None = None, keep: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, n_tokens_edited, n_edits, n_encoded_again (leaves) of every document.

    ``edits`` is a column of type ``EDITS``, or a function that finds the edits (place, removed, added) of a text; places and
    lengths are in bytes of the UTF-8 text. Every document has a tree. With ``keep`` the edited texts (``utf8``) and the tokens of their
    leaves are returned, too; a later call with further edits names these columns as ``text`` and ``leaves`` and encodes only what its
    own edits touch. A null in ``leaves`` has its text counted anew.
    """
    ship(tune(docs.sparkSession))
    given = F.col(f"`{text}`")
    data = F.coalesce(given, F.lit(b"")) if dict(docs.dtypes)[text] == "binary" else F.encode(whole(given), "UTF-8")
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"), data.alias("text"),
        *([] if callable(edits) and not isinstance(edits, Column) else [edits.alias("edits")]),
        *([] if leaves is None else [F.col(f"`{leaves}`").cast("array<int>").alias("leaves")]),
    )
    find = None if "edits" in rows.columns else edits
    schema = "doc_id long, n_tokens long, n_tokens_edited long, n_edits long, n_encoded_again long" + (", utf8 binary, leaves array<int>" if keep else "")
    return rows.mapInArrow(_counted(tokenizer, find, keep), schema)


# What a text must not give away, and what stands in its place.
PRIVATE = re.compile(
    rb"(?P<email>[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"
    rb"|(?P<secret>\b(?i:token|secret|password|api[_-]?key)\b[ \t]*[=:][ \t]*(?:\"[^\"\n]*\"|'[^'\n]*'|[^\s\"']+))"
    rb"|(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3})"
    rb"|(?P<number>\b\d(?:[ -]?\d){11,18}\b)"
)


def redactions(text: bytes) -> list[tuple[int, int, bytes]]:
    """Edits that replace private data by its kind, in order, each placed in the text as the ones before it leave it."""
    out, shift = [], 0
    for match in PRIVATE.finditer(text):
        added = b"[" + match.lastgroup.encode() + b"]"
        out.append((match.start() + shift, match.end() - match.start(), added))
        shift += len(added) - (match.end() - match.start())
    return out
