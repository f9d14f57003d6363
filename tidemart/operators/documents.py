"""From message text to usable documents."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.jsonpath import json_entries, once, split_path

# A key holding a dot or a list index: the document (or part of it) is flattened.
FLAT_KEY = r'"(?=[^"\\]*+"\s*+:)[^"\\]*?(?:\.|\[\d)[^"\\]*+"\s*+:'

_TOKEN = re.compile(
    r"""(?P<dq>"(?:\\.|[^"\\])*")|(?P<sq>'(?:\\.|[^'\\])*')|(?P<word>[A-Za-z_$][\w$]*)"""
    r"""|(?P<comma>,(?=\s*[}\]]))""",
    re.DOTALL,
)
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|.)", re.DOTALL)
# JSON escapes; any other escaped character stands for itself.
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}
_WORDS = {"None": "null", "True": "true", "False": "false", "null": "null", "true": "true", "false": "false"}
_LIST_STEP = re.compile(r"\[(\d+|i)\]")


def _unescape(match):
    code = match.group(1)
    return chr(int(code[1:], 16)) if len(code) == 5 else _ESCAPES.get(code, code)


_COLON = re.compile(r"\s*:")


def _to_strict(text: str) -> str:
    """Rewrite relaxed JSON (Python words, single quotes, bare names, trailing commas) as JSON."""

    def token(match):
        kind, found = match.lastgroup, match.group()
        if kind == "comma":
            return ""
        if kind == "word":
            if found in _WORDS:
                return _WORDS[found]
            named = _COLON.match(text, match.end())
            return json.dumps(found) if named else found
        body = found[1:-1]
        if any(ord(ch) < 32 for ch in body):
            raise ValueError("control character in text")
        return json.dumps(_ESCAPE.sub(_unescape, body), ensure_ascii=False)

    return _TOKEN.sub(token, text)


def _refuse(word):
    raise ValueError(word)


def _plain_steps(path: str) -> list[str]:
    """Steps of a path without list entries, which its names reach through."""
    return [step for step in split_path(path) if not (step.isdigit() or step == "i")]


def _mapped(paths: Iterable[str]) -> dict:
    """Paths as a tree of names; ``None`` marks where one ends."""
    tree: dict = {}
    for path in paths:
        node = tree
        for step in _plain_steps(path):
            node = node.setdefault(step, {})
        node[None] = {}
    return tree


#: Stands for a tree below which everything is mapped, and nothing is.
_ALL, _NONE = {None: {}, "value": {}}, {}
_ALL["value"] = _ALL


def _below(place: dict, steps: list[str]) -> dict:
    """What is mapped below a key; nothing below the end of a path, whose value stays as it is."""
    for step in steps:
        place = place.get(step, place.get("value", _NONE))
        if place is not _ALL and None in place and len(place) == 1:
            return place
    return place


def _is_nested(key: str, place: dict) -> bool:
    """Whether a flattened key stands for a mapped path, a part of one, or entries of a mapped list."""
    if place is not _ALL and None in place and split_path(key)[:1] and split_path(key)[0].isdigit():
        return True
    return bool(_below(place, _plain_steps(key))) if _plain_steps(key) else place is _ALL


def _nest(node, path, singles, place=_ALL):
    """Turn flattened keys on mapped paths back into nested objects and lists."""
    if isinstance(node, list):
        return [_nest(item, path, singles, place) for item in node]
    if not isinstance(node, dict) or not place:
        return node
    flat = [key for key in node if ("." in key or _LIST_STEP.search(key)) and _is_nested(key, place)]
    ends = place is not _ALL and None in place
    out = {key: value if ends and len(place) == 1 else _nest(value, f"{path}{key}.", singles, _below(place, _plain_steps(key)))
           for key, value in node.items() if key not in flat}
    if not flat:
        return out
    built = set()
    for key in flat:
        steps = [s for s in _LIST_STEP.sub(r".\1", key).split(".") if s]
        place = out
        for depth, step in enumerate(steps[:-1]):
            nxt = place.get(step)
            if not isinstance(nxt, dict):
                nxt = place[step] = {}
            place = nxt
            built.add(tuple(steps[: depth + 1]))
        if steps:
            place[steps[-1]] = node[key]

    def compact(value, steps):
        if not isinstance(value, dict):
            return value
        value = {k: compact(v, steps + (k,)) if steps + (k,) in built else v for k, v in value.items()}
        if steps and value and all(k.isdigit() for k in value):
            order = sorted(value, key=int)
            if [int(k) for k in order] == list(range(len(order))):
                if len(order) == 1:
                    singles.append(path + ".".join(steps))
                return [value[k] for k in order]
        return value

    done = {k: compact(v, (k,)) if (k,) in built else v for k, v in out.items()}
    if ends and sorted(done) == sorted(map(str, range(len(done)))):  # a mapped list, flattened within its own object
        return [done[str(k)] for k in range(len(done))] if len(done) > 1 else done["0"]
    return done


def _repair_one(text, place=_ALL):
    if text is None:
        return None, None
    try:
        strict, repeated = True, []

        def fields(pairs):
            found = dict(pairs)
            if len(found) < len(pairs):
                repeated.append(True)
            return found

        try:
            tree = json.loads(text, parse_constant=_refuse, object_pairs_hook=fields)
        except ValueError:
            strict, tree = False, json.loads(_to_strict(text), parse_constant=_refuse)
        singles: list[str] = []
        nested = _nest(tree, "", singles, place)
        if strict and nested == tree and not repeated:
            return text, singles  # no key was flattened: as it came, down to its numbers and blanks
        return json.dumps(nested, ensure_ascii=False, separators=(",", ":")), singles
    except (ValueError, RecursionError):
        return None, None


_REPAIRED = T.StructType([
    T.StructField("doc", T.StringType()),
    T.StructField("singles", T.ArrayType(T.StringType())),
])


@cache
def _repair(paths: frozenset[str] | None):
    place = _ALL if paths is None else _mapped(paths)

    @F.pandas_udf(_REPAIRED)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_repair_one(text, place) for text in texts], columns=["doc", "singles"])

    # Keeps filters on the result from running the repair a second time below them.
    return run.asNondeterministic()


def parse_tolerant_json(df: DataFrame, col: str = "value", paths: Iterable[str] | None = None) -> DataFrame:
    """P1 + P7: add ``doc`` (strict, nested JSON text or NULL) and ``singles``.

    Well-formed documents never reach Python: the repair function receives NULL for them. Only
    documents that fail the strict parse, or hold flattened keys, are repaired there. ``singles``
    lists paths whose flattened list had exactly one entry; such a list reads as its entry when
    the whole list is mapped to a JSON column. With ``paths``, the mapped ones, only keys that stand
    for one of them, for a part or for entries of one are nested; all other content stays as it came.
    """
    text = F.trim(F.col(col))
    good = F.try_parse_json(text).isNotNull() & ~text.rlike(FLAT_KEY)  # of a repeated key, the last value counts
    checked = df.withColumn("_good", once(F.coalesce(good, F.lit(False))))
    fixed = checked.withColumn(
        "_fixed", _repair(None if paths is None else frozenset(paths))(F.when(~F.col("_good") & (text != ""), text))
    )
    return (
        fixed.withColumn("doc", F.when(F.col("_good"), text).otherwise(F.col("_fixed.doc")))
        .withColumn("singles", F.col("_fixed.singles"))
        .drop("_good", "_fixed")
    )


def split_quarantine(df: DataFrame, col: str = "value", paths: Iterable[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Parsed documents, and the non-blank messages that could not be read."""
    parsed = parse_tolerant_json(df, col, paths)
    blank = F.coalesce(F.trim(F.col(col)) == "", F.lit(True))
    return parsed.where("doc is not null"), parsed.where(F.col("doc").isNull() & ~blank).drop("doc", "singles")


def unwrap_envelope(doc: Column) -> Column:
    """The first child of the root when it is a non-empty object, else the root."""
    child = F.get(json_entries(F.when(F.ltrim(doc).startswith("{"), doc)), F.lit(0))
    return F.when(F.ltrim(child).startswith("{") & (child != "{}"), child).otherwise(doc)
