"""Cutting a text where a byte-level BPE tokenizer can never merge across.

The tokenizer's own pre-tokens are "an optional space, then letters / digits / signs" or a run of
white space.  A space that follows a character other than white space therefore always begins a
new pre-token, so a text may be cut before every such space and the pieces encoded apart: the ids
of the text are the ids of the pieces, one after the other.  Special strings hold no space, so
they stay inside one piece and get the library's default handling there.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
_ODD = f"[{_WHITE}][ \n]"
_SAFE_CUT = re.compile(r"(?<=\w)(?= )")
_SAFE_BUT_LINES = re.compile(r"(?<=\w)(?= (?!\n))")


def space_runs(text: str) -> list[str]:
    """Pieces of ``text``: the first as it is, each later one without the space it begins with."""
    if _SPACE_AFTER_SPACE.search(text) is None:
        return text.split(" ")
    # white space before some space: cut only after word characters, where no run can be torn
    head, *rest = _SAFE_CUT.split(text)
    return [head, *(p[1:] for p in rest)]


def split_runs(texts: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """Pieces of many texts (large strings, no nulls): their first ones, all later ones in one array,
    and where each text's end there (from 0 on); no piece becomes a Python string.

    Cut before spaces and, for the same reason, line feeds that follow a character other than white
    space.  A later piece that begins with a line feed stands for itself, any other for a space and itself.
    """
    odd = pa.compute.match_substring_regex(texts, _ODD)
    lists = pa.compute.split_pattern(pa.compute.replace_substring(texts, "\n", " \n"), " ")
    where = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
    if len(where):
        order = np.arange(len(texts))
        order[where] = len(texts) + np.arange(len(where))
        own = []
        for head, *rest in map(_SAFE_BUT_LINES.split, texts.take(pa.array(where)).to_pylist()):
            own.append([head, *(p[1:] for p in rest)])
        lists = pa.concat_arrays([lists, pa.array(own, lists.type)]).take(pa.array(order))
    ends = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)])
    flat = lists.flatten()
    later = np.ones(len(flat), bool)
    later[ends[:-1]] = False
    return flat.take(pa.array(ends[:-1])), flat.filter(pa.array(later)), ends - np.arange(len(ends))
