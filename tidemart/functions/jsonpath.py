"""Mapping paths as columns.

A path is a dotted chain of steps: a name, a list index (``[0]`` or a numeric step), ``[i]`` (any
list entry) or ``value`` (any value of a map). ``DocumentPaths`` parses the document once into the
sections all paths need, parses each shared list once, and answers every path from those columns.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INDEX = re.compile(r"\[(\d+|i)\]")


def once(value: Column) -> Column:
    """Pin the evaluation of an expensive value to its projection.

    Filters above would otherwise be pushed below with the whole expression copied into them, and
    a document would be parsed once per mention. A non-deterministic test keeps the value in place.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def shared(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row, however often it is mentioned.

    Inside a function on lists or a value pinned by :func:`once` Spark would compute each mention anew.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def split_path(path: str) -> list[str]:
    return [step for step in _INDEX.sub(r".\1", path.strip()).split(".") if step]


def dotted(path: str) -> str:
    return ".".join(split_path(path))


def _is_plain(step: str) -> bool:
    return not (step.isdigit() or step in ("i", "value"))


def _quoted(step: str) -> str:
    return "['" + step + "']"


def json_get(text: Column, steps: list[str]) -> Column:
    """Value at ``steps`` as text; a numeric step indexes a list, or names a key of an object."""
    if not steps:
        return text
    if not any(step.isdigit() for step in steps):
        return F.get_json_object(text, "$" + "".join(map(_quoted, steps)))
    by_index = "$" + "".join(f"[{s}]" if s.isdigit() else _quoted(s) for s in steps)
    by_key = "$" + "".join(map(_quoted, steps))
    found = F.get_json_object(text, by_index)
    either = F.coalesce(found, F.get_json_object(text, by_key))
    # A list has no keys, so it isn't parsed again for one.
    return F.when(F.ltrim(text).startswith("["), found).otherwise(either) if steps[0].isdigit() else either


def json_elements(text: Column) -> Column:
    """Entries of a JSON list as texts; NULL when the text is no list."""
    return F.when(F.ltrim(text).startswith("["), F.from_json(text, "array<string>"))


def json_entries(text: Column) -> Column:
    """Entries of a JSON list, or values of a JSON object in document order."""
    return F.coalesce(
        json_elements(text),
        F.when(F.ltrim(text).startswith("{"), F.map_values(F.from_json(text, "map<string,string>"))),
    )


def has_content(text: Column) -> Column:
    """Neither NULL, blank text, empty list nor empty object."""
    return text.isNotNull() & ~F.trim(text).isin("", "[]", "{}")


def content(text: Column) -> Column:
    return F.when(has_content(text), text)


def parse_entries(entries: Column, schema) -> Column:
    return F.transform(entries, lambda e: F.from_json(e, schema))


def _inner_entries(entries: Column, steps: list[str]) -> Column:
    none = F.array().cast("array<string>")
    return F.flatten(F.transform(entries, lambda e: F.coalesce(json_entries(json_get(e, steps)), none)))


class DocumentPaths:
    """Answers many paths on one JSON text column with one parse of the text.

    The text is parsed with a schema that holds only the mapped sections. Objects that are only
    walked through become nested structs; whatever is a target itself, a list or a map stays raw
    text. Lists below ``[i]`` or ``value`` become arrays of structs, parsed once per list.
    """

    def __init__(self, paths):
        self._paths = {path: split_path(path) for path in paths if path and path.strip()}
        self._tree: dict = {}
        for steps in self._paths.values():
            node = self._tree
            for step in steps:
                if not _is_plain(step):
                    node[None] = True  # raw from here on
                    break
                node = node.setdefault(step, {})
            else:
                node[None] = True
        # Lists whose entries several paths share: list steps -> relative steps of the entries.
        self._lists: dict[tuple[str, ...], set[tuple[str, ...]]] = {}
        for steps in self._paths.values():
            cut = self._list_cut(steps)
            if cut is not None:
                head, rest = cut
                self._lists.setdefault(head, set()).add(rest)

    @staticmethod
    def _list_cut(steps):
        """Split at the last any-entry step: (list incl. wildcards, steps inside an entry)."""
        wild = [n for n, step in enumerate(steps) if step in ("i", "value")]
        if not wild:
            return None
        return tuple(steps[: wild[-1] + 1]), tuple(steps[wild[-1] + 1 :])

    def _schema(self, node) -> T.StructType:
        fields = []
        for name, child in node.items():
            if name is None:
                continue
            nested = None not in child
            fields.append(T.StructField(name, self._schema(child) if nested else T.StringType()))
        return T.StructType(fields)

    def _raw(self, doc: Column, steps) -> Column:
        """Text of a path without any-entry steps."""
        node, col = self._tree, doc
        for n, step in enumerate(steps):
            if not _is_plain(step):
                return json_get(col, list(steps[n:]))
            node, col = node[step], col.getField(step)
            if None in node:
                return json_get(col, list(steps[n + 1 :]))
        return col

    def _expand(self, doc: Column, head) -> Column:
        """All entries below a list path, as an array of texts in document order."""
        first = next(n for n, step in enumerate(head) if step in ("i", "value"))
        entries = json_entries(self._raw(doc, head[:first]))
        pending: list[str] = []
        for step in head[first + 1 :]:
            if step not in ("i", "value"):
                pending.append(step)
                continue
            entries = _inner_entries(entries, pending)
            pending = []
        return entries

    def parse(self, df: DataFrame, text: str, prefix: str = "_p") -> DataFrame:
        """Add the parsed sections and shared lists as working columns."""
        self._prefix = prefix
        out = df.withColumn(f"{prefix}doc", once(F.from_json(F.col(text), self._schema(self._tree))))
        doc = F.col(f"{prefix}doc")
        lists, shared = {}, {}
        for n, (head, inside) in enumerate(sorted(self._lists.items())):
            names = sorted({steps[0] for steps in inside if steps})
            schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
            entries = self._expand(doc, head)
            if names:
                entries = parse_entries(entries, schema)
            lists[head] = f"{prefix}list{n}"
            shared[lists[head]] = once(entries)
        self._list_columns = lists
        return out.withColumns(shared) if shared else out

    def working_columns(self) -> list[str]:
        return [f"{self._prefix}doc", *self._list_columns.values()]

    def text(self, path: str) -> Column:
        """Value at the path as it stands; first entry with content for any-entry paths."""
        steps = self._paths[path]
        cut = self._list_cut(steps)
        if cut is None:
            return self._raw(F.col(f"{self._prefix}doc"), steps)
        head, rest = cut
        entries = F.col(self._list_columns[head])
        if not rest:
            values = entries
        else:
            values = F.transform(entries, lambda e: json_get(e.getField(rest[0]), list(rest[1:])))
        return F.get(F.filter(values, has_content), F.lit(0))
