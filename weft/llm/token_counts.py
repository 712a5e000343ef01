"""Token counts of sections: whole texts are encoded once and tokens are attributed by their offsets.

Each text is encoded whole, so its tokens are those a model sees. Token spans come from the lengths of
the token's bytes and end to end cover the text. Sections are spans of the text as well; both lists are
sorted, so the interval join of a text is a binary search of its section borders in its token offsets.

A token that crosses a section border is allocated by an explicit rule:

- ``start``: to the section of its first byte;
- ``majority``: to the section with most of its bytes, the first one of equals;
- ``share``: to every section, by the share of its bytes.

Under each rule the counts of a text's sections add up to its tokens. `crossing` counts the tokens that
a section shares with another.

Nulls, ties, repeats: a null or empty text is one empty section without tokens. Rows are counted one by
one, so repeats agree; a null id is kept. An empty table gives no rows. A very long text is encoded whole, so a task must
hold it and its token offsets. Of the input only the id is returned, so extra columns cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.arrow import map_arrow
from weft.llm.textops import WHITE

STOP = np.zeros(256, bool)
STOP[list(b".!?")] = True
RULES = ("start", "majority", "share")
#: Fixed value: the split pattern that belongs to the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(rank_file: str) -> tuple[Callable[[str], list[int]], np.ndarray]:
    """The encoder of a rank file, and the number of bytes of each token."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    made = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return made.encode_ordinary, lengths


def line_borders(body: np.ndarray) -> np.ndarray:
    """Borders of a text's lines in bytes: 0, behind each line feed, and the end."""
    inner = np.flatnonzero(body == 0x0A) + 1
    return np.concatenate([[0], inner[inner < len(body)], [len(body)]])


def sentence_borders(body: np.ndarray) -> np.ndarray:
    """Borders of a text's sentences in bytes: 0, behind white space that follows . ! or ?, behind line feeds, and the end."""
    if len(body) < 2:
        return np.array([0, len(body)])
    white = WHITE[body]
    stop = STOP[body]
    behind = white[:-1] & ~white[1:]
    run = np.maximum.accumulate(np.where(white, -1, np.arange(len(body))))  # the last byte before that is not white
    closes = behind & (run[:-1] >= 0) & stop[np.maximum(run[:-1], 0)]
    return np.unique(np.concatenate([[0], np.flatnonzero(closes | (body[:-1] == 0x0A)) + 1, [len(body)]]))


def attribute(token_ends: np.ndarray, borders: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them it shares, from the ends of tokens that cover the text.

    Both lists cut the text into fragments, each of which lies in one token and one section.
    """
    sections = len(borders) - 1
    if not len(token_ends):
        return np.zeros(sections), np.zeros(sections, np.int64)
    cuts = np.union1d(token_ends, borders)
    begin = np.concatenate([[0], cuts[:-1]]) if cuts[0] else cuts[:-1]
    size = np.diff(np.append(begin, token_ends[-1]))
    token = np.searchsorted(token_ends, begin, "right")
    section = np.searchsorted(borders[1:-1], begin, "right")
    head = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    parts = np.diff(np.append(head, len(token)))
    shared = np.bincount(section[np.repeat(parts > 1, parts)], minlength=sections)
    if rule == "start":
        return np.bincount(section[head], minlength=sections).astype(float), shared
    if rule == "share":
        whole = np.add.reduceat(size, head)
        return np.bincount(section, weights=size / np.repeat(whole, parts), minlength=sections), shared
    most = np.flatnonzero(size == np.repeat(np.maximum.reduceat(size, head), parts))
    _, at = np.unique(token[most], return_index=True)
    return np.bincount(section[most[at]], minlength=sections).astype(float), shared


def _count(rank_file: str, rule: str, borders_of: Callable[[np.ndarray], np.ndarray], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, lengths = encoding(rank_file)
        for batch in batches:
            row, section, start, end, tokens, crossing, of_text = ([] for _ in range(7))
            for i, text in enumerate(batch.column(0)):
                text = text.as_py() or ""
                body = np.frombuffer(text.encode(), np.uint8)
                ids = np.array(encode(text), np.int64)
                borders = borders_of(body)
                counts, shared = attribute(np.cumsum(lengths[ids]), borders, rule)
                n = len(borders) - 1
                row.append(np.full(n, i))
                section.append(np.arange(n))
                start.append(borders[:-1])
                end.append(borders[1:])
                tokens.append(counts)
                crossing.append(shared)
                of_text.append(np.full(n, len(ids)))
            join = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
            taken = pa.array(join(row, np.int64))
            yield pa.record_batch(
                [*[c.take(taken) for c in batch.columns[1:]], pa.array(join(section, np.int32)), pa.array(join(start, np.int64)),
                 pa.array(join(end, np.int64)), pa.array(join(tokens, np.float64)), pa.array(join(crossing, np.int64)), pa.array(join(of_text, np.int64))],
                names=[*names, "section", "start_byte", "end_byte", "tokens", "crossing", "text_tokens"],
            )

    return run


def section_tokens(
    docs: DataFrame,
    rank_file: str,
    *,
    rule: str = "majority",
    borders_of: Callable[[np.ndarray], np.ndarray] = line_borders,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per section: id, carried columns, section, start_byte, end_byte, tokens, crossing, text_tokens.

    borders_of gives the ascending borders of a text's sections from its bytes, 0 and the length included.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    taken = {"section", "start_byte", "end_byte", "tokens", "crossing", "text_tokens"}
    names = [id_col, *[c for c in carry if c != id_col and c not in taken]]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    slim = docs.select(F.col(text_col).alias("__text"), *[F.col(c).alias(f"__c{i}") for i, c in enumerate(names)])
    schema = f"{kinds}, section int, start_byte long, end_byte long, tokens double, crossing long, text_tokens long"
    return slim.transform(map_arrow, _count(rank_file, rule, borders_of, names), schema)
