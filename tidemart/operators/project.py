"""Config-driven projection of documents to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions import clean
from tidemart.functions.jsonpath import DocumentPaths, content, dotted, has_content, json_elements, json_get, once

# Page titles that are only the shop's brand, and the column holding one sales tip.
BRAND_TITLES = ("Temu",)
TITLE_COLUMN = "title"
TEXT_LIST_COLUMN = "salesTipText"


def normalise_mapping(mapping: dict) -> dict[str, list[str]]:
    """Target -> ordered paths; a trailing ``[]`` or ``{}`` of the target name is dropped."""
    out = {}
    for target, source in mapping.items():
        name = target.strip().removesuffix("[]").removesuffix("{}")
        out[name] = [source] if isinstance(source, str) else list(source)
    return out


def unless_single(value: Column, path: str, singles: Column | None) -> Column:
    """A flattened one-entry list mapped as a whole reads as its entry."""
    if singles is None:
        return value
    single = F.array_contains(singles, dotted(path))
    return F.when(single, F.get_json_object(value, "$[0]")).otherwise(value)


def as_type(value: Column, kind: str) -> Column:
    if kind == "STRING":
        return value
    return clean.CONVERTERS.get(kind, lambda c: c)(value)


def _rule(target: str, value: Column) -> Column:
    """P9."""
    if target == TITLE_COLUMN:
        return F.when(~F.trim(value).isin(*BRAND_TITLES), value)
    if target == TEXT_LIST_COLUMN:
        return F.when(clean.is_container(value), value).otherwise(
            F.when(value.isNotNull(), F.to_json(F.array(value)))
        )
    return value


def coalesce_sources(values: list[Column], target: str, kind: str, paths: list[str] | None = None,
                     singles: Column | None = None) -> Column:
    """First value that has content and converts to the target type."""
    if kind == "JSON" and paths:
        values = [unless_single(value, path, singles) for value, path in zip(values, paths)]

    def converted(value: Column) -> Column:
        return clean.CONVERTERS[kind](_rule(target, content(value)))

    if len(values) == 1:
        return converted(values[0])
    return F.get(F.filter(F.transform(F.array(*values), converted), F.isnotnull), F.lit(0))


def project_by_mapping(df: DataFrame, mapping: dict, types: dict[str, str], doc: str = "doc",
                       mode: str = "strict", singles: str | None = "singles",
                       keep: tuple[str, ...] = (), json_text: tuple[str, ...] = ()) -> DataFrame:
    """One column per entry of ``types``; unmapped targets are NULL, unknown ones ignored.

    ``mode`` is ``strict`` (first named path, value as it stands), ``filled`` (the same, the empty
    text is NULL) or ``eligible`` (ordered sources, P8). ``json_text`` names text columns whose
    value is a whole list or object.
    """
    mapping = {t: [p for p in s if p and p.strip()] for t, s in normalise_mapping(mapping).items()}
    wanted = {t: s if mode == "eligible" else s[:1] for t, s in mapping.items() if t in types}
    paths = DocumentPaths([p for sources in wanted.values() for p in sources])
    parsed = paths.parse(df, doc)
    single_paths = F.col(singles) if singles and singles in df.columns else None

    # All texts in one projection, so that the conversions below read plain fields.
    flat = [(target, n, path) for target, sources in wanted.items() for n, path in enumerate(sources)]
    if flat:
        texts = F.struct(*[paths.text(path).alias(f"{target}_{n}") for target, n, path in flat])
        parsed = parsed.withColumn("_texts", once(texts))

    grouped: dict[str, Column] = {}
    if mode == "eligible":
        parsed, grouped = _convert_by_type(parsed, wanted, types, single_paths, keep)

    columns = [F.col(name) for name in keep]
    for target, kind in types.items():
        if target in keep:
            continue
        if target in grouped:
            columns.append(grouped[target].cast(SPARK_TYPES.get(kind, kind)).alias(target))
            continue
        sources = wanted.get(target, [])
        values = [F.col(f"_texts.{target}_{n}") for n in range(len(sources))]
        if not sources:
            value = F.lit(None)
        elif mode == "eligible":
            value = coalesce_sources(values, target, kind, sources, single_paths)
        else:
            value = values[0]
            if kind == "JSON" or target in json_text:
                value = compact_list(unless_single(value, sources[0], single_paths))
            if mode == "filled":
                value = F.nullif(value, F.lit(""))
            value = as_type(value, kind)
        columns.append(value.cast(SPARK_TYPES.get(kind, kind)).alias(target))
    return parsed.select(*columns)


def _convert_by_type(parsed: DataFrame, wanted: dict[str, list[str]], types: dict[str, str],
                     singles: Column | None, keep) -> tuple[DataFrame, dict[str, Column]]:
    """P8 for all targets of a type at once: one conversion per type instead of one per path.

    A wide mapping would otherwise become a projection of thousands of expressions, which takes
    longer to build and compile than a micro-batch takes to run.
    """
    by_kind: dict[str, list[str]] = {}
    for target in wanted:
        if wanted[target] and target not in (*keep, TITLE_COLUMN, TEXT_LIST_COLUMN):
            by_kind.setdefault(types[target], []).append(target)

    # Texts of a type side by side, as one array that compiled code fills: a function over an array evaluates what
    # it is given expression by expression.
    places, texts = {}, {}
    for kind, targets in by_kind.items():
        texts[kind] = []
        for target in targets:
            values = [F.col(f"_texts.{target}_{n}") for n in range(len(wanted[target]))]
            if kind == "JSON":
                values = [unless_single(v, path, singles) for v, path in zip(values, wanted[target])]
            places[target] = kind, range(len(texts[kind]), len(texts[kind]) + len(values))
            texts[kind] += values
    if texts:
        parsed = parsed.withColumns({f"_of_{kind}": once(F.array(*values)) for kind, values in texts.items()})

    def eligible(kind: str) -> Column:
        # Plain text needs no conversion beyond the test for content, which compiled code does.
        held = F.col(f"_of_{kind}")
        return held if kind == "STRING" else F.transform(held, lambda v: F.when(has_content(v), clean.CONVERTERS[kind](v)))

    def first(kind: str, numbers) -> Column:
        found = [F.get(F.col(f"_as_{kind}"), F.lit(n)) for n in numbers]
        return F.coalesce(*[content(v) if kind == "STRING" else v for v in found])

    made = {f"_as_{kind}": once(eligible(kind)) for kind in texts}
    return (parsed.withColumns(made) if made else parsed), {t: first(*place) for t, place in places.items()}


SPARK_TYPES = {"JSON": "string", "DATETIME": "timestamp_ntz"}


def compact_list(value: Column) -> Column:
    """An object whose keys are 0..n-1 reads as the list of its values (one value: as the value)."""
    return F.when(F.ltrim(value).rlike(r'^\{\s*"\d+"\s*:'), _numbered_list(value)).otherwise(value)


def _numbered_list(text: Column) -> Column:
    def listed(entries: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(entries) - 1)
        values = F.transform(numbers, lambda k: clean.to_json_text(F.element_at(entries, k.cast("string"))))
        return F.when(F.forall(numbers, lambda k: F.map_contains_key(entries, k.cast("string"))), F.when(
            F.size(entries) == 1, F.get(values, F.lit(0))
        ).otherwise(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))))

    # The one-entry array binds the parsed map to a name inside the expression.
    bound = F.transform(F.array(F.from_json(text, "map<string,string>")), listed)
    return F.coalesce(F.get(bound, F.lit(0)), text)


def with_aliases(item: Column, field: str, aliases: tuple[str, ...]) -> Column:
    """P10: the field itself, else its aliases, on one parsed item."""
    return F.coalesce(*[json_get(item.getField(n.split(".")[0]), n.split(".")[1:]) for n in (field, *aliases)])


def embedded_json(text: Column) -> Column:
    """Text that holds a JSON list or object; NULL otherwise."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.when(kind.startswith("ARRAY") | kind.startswith("OBJECT"), text)


def nested_leaves(doc: Column, steps: list[str]) -> Column:
    """All leaves at a path, lists flattened: one scalar as its text, several as a list."""
    bound = F.transform(F.array(_leaves(F.array(doc), steps)), _leaf_text)
    return F.when(F.trim(doc) != "", F.get(bound, F.lit(0)))


def _leaves(nodes: Column, steps: list[str]) -> Column:
    """Children of every node by name; a list stands for its entries."""
    for step in steps:
        entries = F.flatten(F.transform(nodes, lambda n: F.coalesce(json_elements(n), F.array(n))))
        nodes = F.filter(F.transform(entries, lambda n: F.get_json_object(n, "$['" + step + "']")),
                         lambda n: n.isNotNull())
    return F.flatten(F.transform(nodes, lambda n: F.coalesce(json_elements(n), F.array(n))))


def _leaf_text(leaves: Column) -> Column:
    scalar = r'^(-?\d+(\.\d+)?([eE][-+]?\d+)?|true|false|null)$'
    parts = F.transform(leaves, lambda x: F.when(clean.is_container(x) | x.rlike(scalar), x).otherwise(
        F.concat(F.lit('"'), x, F.lit('"'))))
    many = F.concat(F.lit("["), F.array_join(parts, ","), F.lit("]"))
    first = F.get(leaves, F.lit(0))
    return F.when(F.size(leaves) == 0, F.lit(None)).when(
        (F.size(leaves) == 1) & ~clean.is_container(first), first).otherwise(many)


def keep_entries_with(list_text: Column, field: str) -> Column:
    """JSON list reduced to the entries that have ``field``; ``[]`` for anything else."""
    entries = F.filter(
        json_elements(list_text),
        lambda e: F.coalesce(F.array_contains(F.json_object_keys(e), field), F.lit(False)),
    )
    return F.coalesce(F.concat(F.lit("["), F.array_join(entries, ","), F.lit("]")), F.lit("[]"))


def leaf_category(items: Column) -> Column:
    """``catId`` of the first entry flagged ``isLeaf``."""
    parsed = F.transform(json_elements(items), lambda e: F.from_json(e, "isLeaf string, catId variant"))
    leaf = F.filter(parsed, lambda e: F.coalesce(e.isLeaf.isin("true", "1"), F.lit(False)))
    return clean.json_long(F.get(leaf, F.lit(0)).getField("catId"))


def cast_layer(df: DataFrame, types: dict[str, str], derived: dict[str, Column] | None = None) -> DataFrame:
    """Same-named columns converted to the target types, missing ones NULL, the rest dropped."""
    derived = derived or {}
    have = dict(df.dtypes)
    out = []
    for name, kind in types.items():
        spark_type = SPARK_TYPES.get(kind, kind)
        if name in derived:
            value = derived[name]
        elif name not in have:
            value = F.lit(None)
        elif have[name] == "string" and kind in clean.CONVERTERS and kind not in ("STRING", "JSON"):
            value = clean.CONVERTERS[kind](F.col(name))
        else:
            value = F.col(name)
        out.append(value.cast(spark_type).alias(name))
    return df.select(*out)


def stamp(df: DataFrame, run_date=None, run_ts=None) -> DataFrame:
    """Processing date and time, given or taken once per batch."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts is not None else F.current_timestamp()
    day = F.lit(run_date).cast("date") if run_date is not None else F.to_date(ts)
    return df.withColumns({"run_date": day, "run_ts": ts.cast("timestamp_ntz")})
