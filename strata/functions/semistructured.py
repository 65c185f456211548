"""JSON / XML cells and array / JSON serialisation (F-15, F-15b, F-16, IO-12,
IO-13, S-08, S-09).

Values are taken with Spark's built-in JSON path and XPath functions.
``xpath*`` raises on malformed XML, so every XPath read is guarded by a
well-formedness test built on ``from_xml``'s corrupt-record column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

_CORRUPT = "_corrupt_record"

# Fixed values of the reference: entity repairs tried on malformed XML.
XML_ENTITY_FIXES = (("&Lt;", "&lt;"), ("&Gt;", "&gt;"))
XML_BARE_AMPERSAND = r"&(?!amp;|lt;|gt;|apos;|quot;)"


_SPACES = " \t\r\n"
_PROLOG = r"^\s*(?:<\?xml[^>]*\?>\s*)?(?:<!--(?:(?!-->).)*-->\s*)*"


def _single_root(c: Column) -> Column:
    """The document is one root element with nothing after it: it ends by
    closing the element it opened, or is that element self-closed.
    (``from_xml`` reads the first element and ignores what follows.)"""
    root = F.regexp_extract(c, _PROLOG + r"<([A-Za-z_][\w.:-]*)", 1)
    closes = F.endswith(F.rtrim(c, F.lit(_SPACES)), F.concat(F.lit("</"), root, F.lit(">")))
    self_closed = c.rlike(_PROLOG + r"<[A-Za-z_][\w.:-]*(?:\s[^<>]*)?/>\s*$")
    return (root != "") & (closes | self_closed)


def is_wellformed_xml(c: Column) -> Column:
    """True when ``c`` parses as one XML document; NULL for a NULL cell."""
    parsed = F.from_xml(c, f"{_CORRUPT} string",
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return F.when(c.isNull(), F.lit(None)).otherwise(
        F.ltrim(c, F.lit(_SPACES)).startswith("<") & parsed.getField(_CORRUPT).isNull() & _single_root(c))


def repair_xml(c: Column) -> Column:
    """Keep well-formed XML; else fix ``&Lt;``/``&Gt;`` and bare ``&``; still bad -> NULL (F-16)."""
    fixed = c
    for bad, good in XML_ENTITY_FIXES:
        fixed = F.replace(fixed, F.lit(bad), F.lit(good))
    fixed = F.regexp_replace(fixed, XML_BARE_AMPERSAND, "&amp;")
    return (F.when(is_wellformed_xml(c), c)
            .when(is_wellformed_xml(fixed), fixed)
            .otherwise(F.lit(None).cast("string")))


def xml_value(c: Column, path: str, wellformed: Column | None = None) -> Column:
    """String value of the first node an XPath selects (S-08).

    Like T-SQL ``.value('(path)[1]')``: an element gives its text, an
    attribute its value; NULL when nothing matches or the cell is not XML
    (``xpath_string`` alone would return '').
    """
    ok = is_wellformed_xml(c) if wellformed is None else wellformed
    p = F.lit(path)
    return F.when(ok & F.xpath_boolean(c, p), F.xpath_string(c, p))


def xml_exists(c: Column, path: str, wellformed: Column | None = None) -> Column:
    """``.exist(path) = 1`` (S-09); false for missing nodes and non-XML cells."""
    ok = is_wellformed_xml(c) if wellformed is None else wellformed
    return F.coalesce(F.when(ok, F.xpath_boolean(c, F.lit(path))), F.lit(False))


def json_path(path: str) -> str:
    """``a/b`` or ``a.b`` -> ``$.a.b``."""
    return "$." + ".".join(p for p in path.replace("/", ".").split(".") if p)


def default_alias(column: str, key: str) -> str:
    """Default flattened name: ``col_`` + key with ``/`` -> ``_`` and ``@`` -> ``attr_``."""
    return f"{column}_{key.replace('/', '_').replace('@', 'attr_')}"


def xml_key_path(key: str) -> str:
    """Config key -> XPath: ``p/@a`` is the attribute of the first ``//p``; ``a/b`` the text."""
    if "/@" in key:
        node, attr = key.rsplit("/@", 1)
        return f"(//{node})[1]/@{attr}"
    return f"//{key}/text()"


def parse_keys(column: str, keys) -> list[tuple[str, str]]:
    """Config ``keys_to_extract`` -> [(path, alias)]."""
    out = []
    for item in keys or []:
        if isinstance(item, dict):
            out.append((item["path"], item.get("alias", item["path"])))
        else:
            out.append((item, default_alias(column, item)))
    return out


def flatten_cell(c: Column, path: str, wellformed: Column | None = None, tree: Column | None = None) -> Column:
    """One key of a JSON or XML cell, chosen per row by the first character.

    XML keys are evaluated anywhere below the root (``//key``) as in the
    reference.  With ``tree`` (see ``xml_tree``) they are read from it; only
    cells that have no tree are parsed again, by ``xpath``.
    """
    ok = is_wellformed_xml(c) if wellformed is None else wellformed
    value = F.get(F.xpath(c, F.lit(xml_key_path(path))), 0)
    if tree is not None:
        value = F.when(tree.isNull(), value).otherwise(tree_value(tree, path))
    return F.when(looks_like_json(c), F.get_json_object(c, json_path(path))).when(ok, value)


def flatten(df: DataFrame, config: dict) -> DataFrame:
    """Add one column per configured key (F-15), or with ``extract_all`` one
    per top-level key or element found (F-15b)."""
    for column, cfg in (config or {}).items():
        if column not in df.columns:
            continue
        if cfg.get("extract_all"):
            kind = cfg.get("format", "").lower()
            df = extract_all(df, column, json=kind != "xml", xml=kind != "json",
                             limit=int(cfg.get("max_columns", MAX_NAMES)))
            continue
        keys = parse_keys(column, cfg.get("keys_to_extract"))
        if not keys:
            continue
        ok_col, tree_col = f"__{column}_xml_ok", f"__{column}_xml_tree"
        df = df.withColumn(ok_col, is_wellformed_xml(F.col(column)))
        df = df.withColumn(tree_col, F.when(F.col(ok_col), xml_tree(F.col(column))))
        df = df.withColumns({alias: flatten_cell(F.col(column), path, F.col(ok_col), F.col(tree_col))
                             for path, alias in keys}).drop(ok_col, tree_col)
    return df


def looks_like_json(c: Column) -> Column:
    """Whether a cell is JSON, by its first character; any other is taken for XML."""
    head = F.ltrim(c)
    return head.startswith("{") | head.startswith("[")


#: Columns that ``extract_all`` makes of one column at most.
MAX_NAMES = 2000


def extract_all(df: DataFrame, column: str, json: bool = True, xml: bool = True, limit: int = MAX_NAMES) -> DataFrame:
    """One column per name found in a column (F-15b), chosen cell by cell: the
    top-level keys of JSON cells, elements and attributes of XML cells.

    Every cell is parsed once, JSON into a map, so a key may hold any character,
    and XML into a tree.  The names are one aggregate over the parsed cells.
    More than ``limit`` of them raise an error: ids used as keys are no columns.
    A name that the frame already has raises one too.  ``json`` or ``xml`` may be
    switched off where a column's kind is known.

    Parsing takes far longer than reading, and a small file of many cells is one
    or a few splits, so the rows are first spread over all tasks.
    """
    c, have = F.col(column), set(df.columns)
    df = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parsed, ok, tree = f"__{column}_json", f"__{column}_xml_ok", f"__{column}_xml_tree"
    names = []
    if json:
        df = df.withColumn(parsed, F.from_json(F.when(looks_like_json(c), c), "map<string,string>"))
        names.append(F.transform(F.map_keys(F.col(parsed)), lambda k: F.concat(F.lit("j"), k)))
    if xml:
        cell = F.when(~looks_like_json(c), c)
        df = df.withColumn(ok, is_wellformed_xml(cell))
        df = df.withColumn(tree, F.when(F.col(ok), xml_tree(cell)))
        names.append(F.when(F.col(ok), F.coalesce(tree_names(F.col(tree)), xpath_names(c))))
    empty = F.array().cast("array<string>")
    each = F.concat(*[F.coalesce(n, empty) for n in names]) if names else empty
    # Distinct names, partial on every task; one more than the limit is enough to know.
    rows = df.select(F.explode(F.array_distinct(each)).alias("n")).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {column} holds more than {limit} names; ids used as keys are no columns")
    found: dict[str, Column] = {}
    for name in sorted(r["n"] for r in rows):
        kind, key = name[0], name[1:]
        if kind == "j":
            value = F.try_element_at(F.col(parsed), F.lit(key))
        else:
            value = F.when(F.col(ok), F.when(F.col(tree).isNull(), xpath_last(c, kind, key))
                           .otherwise(tree_last(F.col(tree), kind, key)))
        out = key if kind != "a" else key.replace("/", "_attr_")
        found[out] = F.coalesce(found[out], value) if out in found else value
    taken = sorted(set(found) & have)
    if taken:
        raise ValueError(f"column {column} holds names that the table already has: {taken}")
    return df.withColumns(found).drop(parsed, ok, tree) if found else df.drop(parsed, ok, tree)


def json_cell(c: Column, dtype) -> Column:
    """JSON column value written as JSON text; text is passed through (IO-12)."""
    if dtype.typeName() in ("struct", "map", "array"):
        return F.to_json(c)
    return c.cast("string")


def pg_array_text(c: Column, dtype) -> Column:
    """Array cell as ``{a,b,c}``; NULL elements print ``None``; non-array -> NULL (IO-13)."""
    if dtype.typeName() != "array":
        return F.lit(None).cast("string")
    return F.concat(F.lit("{"), F.array_join(c.cast("array<string>"), ",", "None"), F.lit("}"))


class XmlDoc:
    """Several absolute paths read from one parse of each XML cell.

    ``xpath*`` functions parse the document once per call; reading five values
    and two existence flags that way costs a dozen parses per row.  Here the
    paths (``/Root/A/B/@attr`` or ``/Root/A/B`` for text, as in T-SQL
    ``.value('(path)[1]')``) are compiled into one ``from_xml`` schema.  Every
    element is declared as an array, so the first node in document order is
    taken, as ``[1]`` does.  The root element's name is not checked.
    """

    def __init__(self, cell: Column, paths: list[str]):
        self.cell = cell
        self.tree: dict = {}
        for p in paths:
            steps = self._steps(p)
            node = self.tree
            for s in steps[:-1]:
                node = node.setdefault(s, {})
            last = steps[-1]
            if last.startswith("@"):
                node.setdefault("@", set()).add(last[1:])
            else:
                node.setdefault(last, {})["#text"] = True
        root = self._type(self.tree, root=True)
        root = StructType(root.fields + [StructField(_CORRUPT, StringType())])
        self._set(F.from_xml(cell, root, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT,
                                          "ignoreSurroundingSpaces": "false"}))

    def _set(self, parsed: Column) -> None:
        self.parsed = parsed
        self.ok = F.when(self.cell.isNull(), F.lit(None)).otherwise(
            F.ltrim(self.cell).startswith("<") & parsed.getField(_CORRUPT).isNull() & _single_root(self.cell))

    def bind(self, df: DataFrame, name: str = "_xml") -> DataFrame:
        """Materialise the parsed struct as column ``name``; later reads use it."""
        df = df.withColumn(name, self.parsed)
        self._set(F.col(name))
        return df

    @staticmethod
    def _steps(path: str) -> list[str]:
        steps = [s for s in path.split("/") if s]
        if not path.startswith("/") or len(steps) < 2:
            raise ValueError(f"absolute path below the root expected: {path}")
        return steps[1:]

    @staticmethod
    def _is_text_leaf(node: dict) -> bool:
        return node.get("#text", False) and set(node) == {"#text"}

    def _type(self, node: dict, root: bool = False):
        fields = [StructField(f"_{a}", StringType()) for a in sorted(node.get("@", ()))]
        for name, sub in node.items():
            if name in ("@", "#text"):
                continue
            fields.append(StructField(name, ArrayType(self._type(sub))))
        if not root and self._is_text_leaf(node):
            return StringType()
        if not root and node.get("#text"):
            fields.append(StructField("_VALUE", StringType()))
        return StructType(fields)

    def value(self, path: str) -> Column:
        """First value at ``path``; NULL when absent or the cell is not XML."""
        steps = self._steps(path)
        attr = steps[-1][1:] if steps[-1].startswith("@") else None
        elems = steps[:-1] if attr else steps
        if not elems:
            out = self.parsed.getField(f"_{attr}")
        else:
            arr = self.parsed.getField(elems[0])
            node = self.tree[elems[0]]
            for e in elems[1:]:
                arr = F.flatten(F.transform(F.filter(arr, lambda x, e=e: x.getField(e).isNotNull()),
                                            lambda x, e=e: x.getField(e)))
                node = node[e]
            if attr:
                vals = F.transform(arr, lambda x: x.getField(f"_{attr}"))
            elif self._is_text_leaf(node):
                vals = arr
            else:
                vals = F.transform(arr, lambda x: x.getField("_VALUE"))
            out = F.get(F.filter(vals, lambda v: v.isNotNull()), 0)
        return F.when(self.ok, out)

    def exists(self, path: str) -> Column:
        """``.exist(path) = 1`` for an attribute or a text node."""
        return F.coalesce(self.value(path).isNotNull(), F.lit(False))


# --- the tree of an XML cell: its tags and texts, read once, in document order

#: A tag, whose attribute values may hold any character, or a run of text.
_TOKEN = r"""<[^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+>|[^<]+"""
_ATTRIBUTE = r"""\s[^\s=<>"']+\s*=\s*(?:"[^"]*"|'[^']*')"""
#: Comments, CDATA, instructions, numbered characters, qualified names: cells that XPath reads instead.
_UNUSUAL = r"""<[!?]|&#|</?[^\s<>/="']*:|\s[^\s<>/="']*:[^\s<>/="']*\s*="""
_ENTRY = "struct<path:string,text:string,lead:boolean,attrs:array<struct<name:string,value:string>>>"


def _decoded(t: Column) -> Column:
    """Text with its five entities put back."""
    out = t
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.when(t.contains("&"), out).otherwise(t)


def xml_tree(c: Column) -> Column:
    """Elements and texts of a well-formed cell in document order (``_ENTRY``).

    An element is its path and attributes; a text its element's path, the text,
    and whether it leads: nothing but the start tag stands before it.  NULL for
    cells of unusual markup.
    """
    body = F.regexp_replace(F.regexp_replace(c, r"^\s*<\?xml[^>]*\?>", ""), "\r\n?", "\n")

    def attribute(a: Column) -> Column:
        quoted = F.trim(F.regexp_extract(a, "(?s)=(.*)$", 1))
        value = F.translate(F.substring(quoted, F.lit(2), F.length(quoted) - 2), "\n\t", "  ")
        return F.struct(F.regexp_extract(a, r"^\s([^\s=]+)", 1).alias("name"), _decoded(value).alias("value"))

    def step(state: Column, t: Column) -> Column:
        start, end = t.startswith("<"), t.startswith("</")
        closed = t.endswith("/>")
        child = F.concat(state["path"], F.lit("/"), F.regexp_extract(t, r"^<([^\s/>]+)", 1))
        attrs = F.transform(F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(0)), attribute)
        none = F.lit(None).cast("string")
        element = F.struct(child.alias("path"), none.alias("text"), F.lit(False).alias("lead"), attrs.alias("attrs"))
        text = F.struct(state["path"].alias("path"), _decoded(t).alias("text"), state["lead"].alias("lead"),
                        F.lit(None).cast("array<struct<name:string,value:string>>").alias("attrs"))
        path = (F.when(end, F.regexp_replace(state["path"], "/[^/]*$", ""))
                .when(start & ~closed, child).otherwise(state["path"]))
        out = F.when(end, state["out"]).otherwise(
            F.concat(state["out"], F.array(F.when(start, element).otherwise(text))))
        return F.struct(path.alias("path"), (start & ~end & ~closed).alias("lead"),
                        out.cast(f"array<{_ENTRY}>").alias("out"))

    tokens = F.regexp_extract_all(body, F.lit(_TOKEN), F.lit(0))
    zero = F.struct(F.lit("").alias("path"), F.lit(False).alias("lead"),
                    F.array().cast(f"array<{_ENTRY}>").alias("out"))
    # Text outside the root is white space, and no text of any element.
    entries = F.filter(F.aggregate(tokens, zero, step)["out"], lambda e: e["path"] != "")
    return F.when(~body.rlike(_UNUSUAL), entries)


def _ends(path: Column, key: str) -> Column:
    return path.endswith("/" + key)


def tree_value(tree: Column, key: str) -> Column:
    """``//key/text()``, or for ``p/@a`` attribute a of the first ``//p``: the first in document order."""
    if "/@" in key:
        node, attr = key.rsplit("/@", 1)
        first = F.get(F.filter(tree, lambda e: e["text"].isNull() & _ends(e["path"], node)), 0)
        return F.get(F.filter(first["attrs"], lambda a: a["name"] == attr), 0)["value"]
    return F.get(F.filter(tree, lambda e: e["text"].isNotNull() & _ends(e["path"], key)), 0)["text"]


def _local(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def tree_names(tree: Column) -> Column:
    """``e`` + name of elements with a leading text that is not blank, ``a`` + element/attribute of attributes."""
    texts = F.filter(tree, lambda e: e["lead"] & (F.trim(e["text"]) != ""))
    pairs = F.flatten(F.transform(F.filter(tree, lambda e: e["attrs"].isNotNull()), lambda e: F.transform(
        e["attrs"], lambda a: F.concat(F.lit("a"), _local(e["path"]), F.lit("/"), a["name"]))))
    return F.concat(F.transform(texts, lambda e: F.concat(F.lit("e"), _local(e["path"]))), pairs)


def tree_last(tree: Column, kind: str, key: str) -> Column:
    """The last leading text of an element name, stripped; or the last value of ``element/attribute``."""
    if kind == "e":
        held = F.filter(tree, lambda e: e["lead"] & _ends(e["path"], key) & (F.trim(e["text"]) != ""))
        return F.trim(F.try_element_at(held, F.lit(-1))["text"])
    node, attr = key.rsplit("/", 1)
    held = F.filter(tree, lambda e: _ends(e["path"], node) & F.exists(e["attrs"], lambda a: a["name"] == attr))
    last = F.try_element_at(held, F.lit(-1))
    return F.get(F.filter(last["attrs"], lambda a: a["name"] == attr), 0)["value"]


_NAME = r"[A-Za-z_][\w.\-]*"


def xpath_names(c: Column) -> Column:
    """Names as ``tree_names`` gives them, for cells without a tree: by pattern, with local names."""
    tags = F.regexp_extract_all(c, F.lit(rf"<(?:{_NAME}:)?({_NAME})(?:\s[^>]*)?(?<!/)>[^<]*[^<\s]"), F.lit(1))
    with_attrs = F.regexp_extract_all(
        c, F.lit(rf"<(?:{_NAME}:)?({_NAME}(?:\s+{_NAME}\s*=\s*(?:\"[^\"]*\"|'[^']*'))+)"), F.lit(1))
    pairs = F.flatten(F.transform(with_attrs, lambda s: F.transform(
        F.regexp_extract_all(s, F.lit(rf"\s({_NAME})\s*="), F.lit(1)),
        lambda a: F.concat(F.lit("a"), F.regexp_extract(s, rf"^({_NAME})", 1), F.lit("/"), a))))
    return F.concat(F.transform(tags, lambda t: F.concat(F.lit("e"), t)), pairs)


def xpath_last(c: Column, kind: str, key: str) -> Column:
    """``tree_last`` for cells without a tree."""
    if kind == "e":
        # the element's leading text (before its first child), lxml's ``.text``
        texts = F.xpath(c, F.lit(f"//*[local-name()='{key}']/text()[not(preceding-sibling::*)]"))
        return F.trim(F.try_element_at(F.filter(texts, lambda x: F.trim(x) != ""), F.lit(-1)))
    node, attr = key.rsplit("/", 1)
    return F.try_element_at(F.xpath(c, F.lit(f"//*[local-name()='{node}']/@{attr}")), F.lit(-1))


def xml_extract_all(df: DataFrame, column: str) -> DataFrame:
    """``extract_all`` of a column known to hold XML."""
    return extract_all(df, column, json=False)
