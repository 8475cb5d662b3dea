"""Token counts of whole texts; huge ones by overlapping chunks that are resynchronised."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame

from ebbtide.llm.common import narrow
from ebbtide.llm.pretokens import ByteCounts, of_worker

HUGE = 1 << 15
CHUNK = 1 << 14
OVERLAP = 1 << 8


def count_by_chunks(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """Tokens of ``text``, and how often an overlap had to be widened; holds a chunk's tokens at a time.

    Neighbouring chunks both encode the characters around their border. They are spliced at the last
    character there that starts a token in both and is a proven boundary (``_proven``): pre-tokens
    never run over such a place, so the left tokens before it and the right ones from it on are those
    of the whole text. Where the overlap has no such place, it is doubled, until there is one, the
    right chunk swallows the left or the text ends, which needs no splice. A run without any
    boundary is one pre-token, which has to be encoded whole; it is passed over once.
    """

    def encoded(lo: int, hi: int):
        return [lo + a for a, _ in tokenizer.encode(text[lo:hi], add_special_tokens=False).offsets]

    total, widened, start = 0, 0, 0
    while True:
        end, reach = start + chunk, overlap
        if end + reach >= len(text):
            return total + len(encoded(start, len(text))), widened
        left = encoded(start, end + reach)
        while True:
            lo, hi = max(start, end - reach), end + reach
            right = encoded(lo, hi)
            splice = _common_start(text, left, right, max(lo, start + 1), hi)
            if splice is not None:
                break
            widened += 1
            reach *= 2
            if end + reach >= len(text):
                return total + len(encoded(start, len(text))), widened
            left = encoded(start, end + reach)
        total += sum(a < splice for a in left)
        start = splice


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


def _proven(text: str, at: int) -> bool:
    """Whether a pre-token starts at this place of every text that has these two characters there.

    A space after a character that is no white space; a letter next to a digit; a letter outside ASCII
    next to a punctuation mark outside ASCII. No special string has any of these.
    """
    a, b = text[at - 1], text[at]
    if b == " ":
        return not a.isspace()
    if a.isascii() or b.isascii():
        return _letter(a) and _digit(b) or _digit(a) and _letter(b)
    marks = [unicodedata.category(c)[0] for c in (a, b)]
    return marks in (["L", "P"], ["P", "L"])


def _common_start(text: str, left: list[int], right: list[int], lo: int, hi: int) -> int | None:
    """The last proven place in [lo, hi) where both encodings start a token."""
    for p in sorted(set(left).intersection(right), reverse=True):
        if lo <= p < hi and _proven(text, p):
            return p
    return None


def count_tokens(
    docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", max_tokens: int = 1024
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, n_widened`` of every row of ``docs``, in one pass without a shuffle.

    ``tokenizer_file`` is a byte-level tokenizer in the JSON format, at the same place on every
    machine. Counts are without special tokens, except those written in a text, which the library
    takes as such by default. A null or empty text has 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted each; an empty table gives an empty result. Texts over 32,768
    characters go by chunks (``n_widened``: overlaps that had to be widened), so that a task holds the
    tokens of one chunk, or of the longest run without a boundary, not of a whole text.
    """

    def run(batches):
        counts = of_worker(ByteCounts, tokenizer_file)
        for batch in batches:
            sizes, tokens, widened = [], [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                n, w = count_by_chunks(counts.tokenizer, text) if len(text) > HUGE else (counts.count(text), 0)
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                tokens.append(n)
                widened.append(w)
            over = [n > max_tokens for n in tokens]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over), pa.array(widened, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_widened"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, doc_id=id_col, text=text_col).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, n_widened long"
    )
