"""Struct schemas: text to fields, registry versions, nested layouts with byte offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklake.functions.binary import CODE, WIDTHS, literal_map, utf8_lossy
from tracklake.functions.paths import join_path, last_part
from tracklake.operators.lookup import HOT_ROWS, hot_groups
from tracklake.operators.ordered import fill_forward
from tracklake.operators.quality import is_schema
from tracklake.session import stage, stage_counted

MAX_ELEMENTS = (1 << 31) - 1  # a BINARY value cannot be longer
ALIASES = {"float32": "float", "float64": "double"}
SCHEMA = ["recording", "struct_name"]
EPOCH = ["recording", "struct_name", "schema_seq"]
#: Arrays of structs around a field, from the outside: where they stand, and their counts.
ARRAYS = "array<struct<at:string,n:bigint>>"
DIMS = "array<struct<n:bigint,stride:bigint>>"
LEAVES = f"array<struct<offset:bigint,pieces:array<string>,dims:{DIMS},prim:string,count:int,width:int>>"
#: Sizes stop here: one more than any value has, and small enough for the product of two.
TOO_LARGE = MAX_ELEMENTS + 1
#: Elements that one generated array holds.
CHUNK = 4096
#: Elements up to which a leaf is spread beside the layouts, not at each record. Either way gives the same cells.
SPREAD = 256

_WS = r"[ \t\r\n]*"
_IDENT = r"[A-Za-z_][A-Za-z0-9_]*"
_BETWEEN_FIELDS = r";(?![^{}]*\})"
_LABEL = rf"({_IDENT}){_WS}={_WS}([+-]?[0-9]+)"
_ENUM = rf"^\{{({_WS}{_IDENT}{_WS}={_WS}[+-]?[0-9]+{_WS}[;,]?)*{_WS}\}}$"
# 1 enum block, 2 type, 3 name, 4 count, 5 whatever is left over
_FIELD = (
    rf"(?s)^{_WS}(?:(?:enum)?{_WS}(\{{[^{{}}]*\}}){_WS})?({_IDENT})[ \t\r\n]+({_IDENT}){_WS}"
    rf"(?:\[{_WS}([0-9]+){_WS}\])?{_WS}(.*)$"
)

_MARK = "\x01"


def _enum_labels(block: Column) -> Column:
    names = F.regexp_extract_all(block, F.lit(_LABEL), F.lit(1))
    numbers = F.regexp_extract_all(block, F.lit(_LABEL), F.lit(2))
    pairs = F.arrays_zip(names.alias("label"), numbers.alias("number"))
    rest = lambda i: F.slice(names, i + F.lit(2), F.size(names))
    kept = F.filter(pairs, lambda p, i: ~F.array_contains(rest(i), p["label"]))  # a later label wins
    return F.map_from_entries(F.transform(kept, lambda p: F.struct(p["label"], p["number"].try_cast("bigint"))))


def _field(cut: Column) -> Column:
    """A field from what ``_cut`` made of its text."""
    # an empty text is never cast: each failed cast is an exception inside, dearer than all patterns of a field
    number = F.when(cut["count"] != "", cut["count"].try_cast("bigint"))
    block, count = cut["block"], F.nullif(number, F.lit(0).cast("bigint"))
    return F.struct(
        (cut["ok"] & ((block == "") | block.rlike(_ENUM))).alias("ok"),
        F.trim(cut["rest"]).alias("rest"),
        cut["field"].alias("field"),
        cut["type"].alias("type"),
        count.alias("count"),
        F.when(block != "", _enum_labels(block)).alias("enum"),
    )


def _cut(piece: Column) -> Column:
    """The groups of ``_FIELD``, all empty where it does not match.

    One replacement yields them: type, name and count hold no mark, and a block ends with its only closing brace.
    """
    whole = F.when(piece.rlike(_FIELD), F.split(F.regexp_replace(piece, _FIELD, f"$2{_MARK}$3{_MARK}$4{_MARK}$1|$5"), _MARK, 4))
    return F.transform(F.array(whole), _groups)[0]


def _groups(part: Column) -> Column:
    last = F.get(part, 3)
    end = F.when(F.startswith(last, F.lit("{")), F.locate("}", last)).otherwise(0)
    empty = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(
        part.isNotNull().alias("ok"),
        empty(F.get(part, 0)).alias("type"),
        empty(F.get(part, 1)).alias("field"),
        empty(F.get(part, 2)).alias("count"),
        empty(F.substring(last, F.lit(1), end)).alias("block"),
        empty(F.substring(last, end + F.lit(2), F.length(last))).alias("rest"),
    )


def parse_schema_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fields`` (array in declaration order) and ``incomplete`` for a schema text column.

    Reading stops at the first field that does not parse; ``incomplete`` says that
    something other than blanks was left.
    """
    out = df.withColumn("_pieces", F.split(text, _BETWEEN_FIELDS))
    out = out.withColumn("_cut", F.transform("_pieces", _cut)).withColumn("_parsed", F.transform("_cut", _field))
    out = out.withColumn(
        "_stop", F.array_position(F.transform("_parsed", lambda p: p["ok"] & (p["rest"] == "")), False).cast("int")
    )
    stopped = F.col("_stop") > 0
    at_stop = F.try_element_at("_parsed", F.greatest(F.col("_stop"), F.lit(1)))
    n_kept = F.when(stopped & at_stop["ok"], F.col("_stop")).when(stopped, F.col("_stop") - 1).otherwise(
        F.size("_parsed")
    )
    left = F.when(at_stop["ok"], at_stop["rest"]).otherwise("")
    tail = F.array_join(
        F.slice("_pieces", F.when(at_stop["ok"], F.col("_stop") + 1).otherwise(F.greatest(F.col("_stop"), F.lit(1))),
                F.size("_pieces")), ""
    )
    out = out.withColumn("incomplete", stopped & (F.regexp_replace(F.concat(left, tail), r"[ \t\r\n]", "") != ""))
    out = out.withColumn("_kept", F.slice("_parsed", F.lit(1), n_kept))
    names = F.transform("_kept", lambda p: p["field"])
    # a repeated name replaces the earlier field
    once = F.filter("_kept", lambda p, i: ~F.array_contains(F.slice(names, i + F.lit(2), F.size("_kept")), p["field"]))
    return out.withColumn(
        "fields",
        F.transform(
            once,
            lambda p: F.struct(
                p["field"].alias("field"),
                F.coalesce(F.try_element_at(literal_map(ALIASES), p["type"]), p["type"]).alias("type"),
                p["count"].alias("count"),
                p["enum"].alias("enum"),
            ),
        ),
    ).drop("_pieces", "_cut", "_parsed", "_stop", "_kept")


def schemas(keyed: DataFrame) -> DataFrame:
    """One row per schema record: (recording, struct_name, schema_seq, text, fields, incomplete)."""
    name = last_part(F.col("key"))
    rows = keyed.filter(is_schema()).select(
        "recording",
        F.when(name == "", "struct:Unknown").otherwise(name).alias("struct_name"),
        F.col("seq").alias("schema_seq"),
        utf8_lossy(F.col("data")).alias("text"),
    )
    return parse_schema_text(rows)


def schema_fields(schemas: DataFrame) -> DataFrame:
    return schemas.select(*EPOCH, F.posexplode("fields").alias("pos", "f")).select(
        *EPOCH, "pos", "f.field", "f.type", "f.count", "f.enum"
    )


def versions(schemas: DataFrame, min_rows: int = HOT_ROWS) -> DataFrame:
    """Registrations that change a struct, each with the ``seq`` span it is the newest for."""
    if not hot_groups(schemas, SCHEMA, min_rows):
        min_rows = None
    slim = schemas.select(*EPOCH, "text", "fields", "incomplete")
    seen = fill_forward(slim, SCHEMA, ["schema_seq"], {"_prev": F.col("text")}, inclusive=False, min_rows=min_rows)
    changed = seen.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col("text"))).drop("_prev", "text")
    # the next change = the newest one in descending order
    down = changed.withColumn("_down", -F.col("schema_seq"))
    closed = fill_forward(
        down, SCHEMA, ["_down"], {"_next": F.col("schema_seq")}, inclusive=False, min_rows=min_rows
    )
    return closed.drop("_down").withColumn("until_seq", F.coalesce("_next", F.lit((1 << 63) - 1))).drop("_next")


def _references(vers: DataFrame) -> DataFrame:
    """(recording, parent, type, always): the nested types of each struct, and whether all its versions have them."""
    types = F.array_distinct(F.transform("fields", lambda f: f["type"]))
    used = vers.select("recording", F.col("struct_name").alias("parent"), F.explode(types).alias("type")).filter(~F.col("type").isin(*WIDTHS))
    uses = used.groupBy("recording", "parent", "type").agg(F.count(F.lit(1)).alias("_uses"))
    counts = vers.groupBy("recording", F.col("struct_name").alias("parent")).agg(F.count(F.lit(1)).alias("_versions"))
    return uses.join(counts, ["recording", "parent"]).select("recording", "parent", "type", (F.col("_uses") == F.col("_versions")).alias("always"))


def _resolved(refs: DataFrame, names: DataFrame) -> DataFrame:
    """(recording, type, child): the struct that a type names, in any of its versions; ``struct:`` names come first."""
    known = names.select("recording", F.col("struct_name").alias("child"))
    options = refs.select("recording", "type").distinct().withColumn("child", F.explode(F.array(F.concat(F.lit("struct:"), "type"), F.col("type"))))
    return options.join(known, ["recording", "child"], "left_semi").groupBy("recording", "type").agg(
        F.max(F.struct(F.startswith("child", F.lit("struct:")), "child"))["child"].alias("child")
    )


def layouts(vers: DataFrame) -> DataFrame:
    """Layout of every struct at every registration that concerns it.

    Registrations before every struct that all versions nest was first there are left out, as no layout can be complete at them:
    a record there waits for the next one, whether they are listed or not.
    (recording, struct_name, schema_seq, complete, missing, problem, struct_size, leaves), with
    leaves in byte order: (pieces, dims, prim, offset, count, width). A layout is as large as
    its schema text whatever the counts in it: an array of structs is one ``length`` leaf and one set of leaves with a dimension
    (n, stride) more. Element (i, j, ..) of a leaf lies at ``offset`` + i * stride + j * stride ..,
    its path has the indexes between the ``pieces``. ``leaf_elements`` makes them.
    """
    vers = stage(vers, "schema-versions")
    firsts = vers.groupBy(*SCHEMA).agg(F.min("schema_seq").alias("need"))
    refs, nested = stage_counted(_references(vers), "schema-references")
    if nested:
        children = stage(_resolved(refs, firsts), "schema-children")
        edges = stage(refs.join(children, ["recording", "type"]).groupBy("recording", "parent", "child").agg(F.max("always").alias("always")), "schema-edges")
        epochs = _epochs(vers, _needs(firsts, edges), edges)
        steps = stage(_steps(children, vers), "schema-steps")
    else:
        epochs = vers.select(*EPOCH)
    own = vers.select(*SCHEMA, F.col("schema_seq").alias("_from"), "until_seq", "fields", "incomplete")
    roots = epochs.join(own, SCHEMA).filter("schema_seq >= _from and schema_seq < until_seq").drop("_from", "until_seq")
    level = roots.select(
        *EPOCH, F.col("incomplete").alias("_bad"), F.array("struct_name").alias("_above"),
        F.array().cast("array<int>").alias("_order"), F.lit("").alias("_path"),
        F.array().cast("array<string>").alias("_pieces"), F.array().cast(ARRAYS).alias("_arrays"),
        F.posexplode("fields").alias("_pos", "_f"),
    )
    parts = []
    while True:  # a struct that holds itself ends in _descend
        level = level.withColumn("_order", F.array_append("_order", F.col("_pos"))).withColumn(
            "leaf_path", join_path(F.col("_path"), F.col("_f.field"))
        )
        plain = F.col("_f.type").isin(*WIDTHS)
        parts.append(_leaf_rows(level.filter(plain), F.col("_f.type"), F.col("_f.count")))
        if not nested:
            break
        level, pending = stage_counted(level.filter(~plain), "schema-level")
        if not pending:
            break
        level, found = _descend(level, steps)
        parts.append(found)
    leaves = parts[0]
    for more in parts[1:]:
        leaves = leaves.unionByName(more)
    return _assemble(roots, leaves)


def _needs(firsts: DataFrame, edges: DataFrame) -> DataFrame:
    """(recording, struct_name, need): the first registration at which everything that a struct always nests, at any depth, is there.

    Jumps double: after k rounds ``need`` covers what lies less than 2^k deep, and ``far`` leads to what lies 2^k deep. So chains take as
    many rounds as their length has binary digits; a round that changes nothing is the last one, also where structs hold themselves.
    """
    needs, far = firsts, edges.filter("always").select("recording", "parent", "child")
    while True:
        below = needs.select("recording", F.col("struct_name").alias("child"), F.col("need").alias("_below"))
        most = far.join(below, ["recording", "child"]).groupBy("recording", F.col("parent").alias("struct_name")).agg(F.max("_below").alias("_below"))
        raised = needs.join(most, SCHEMA, "left")
        raised = raised.select(*SCHEMA, F.greatest("need", "_below").alias("need"), (F.col("_below") > F.col("need")).alias("_up"))
        raised = stage(raised, "schema-needs")
        needs = raised.select(*SCHEMA, "need")
        if raised.filter("_up").isEmpty():
            return needs
        on = far.select("recording", F.col("parent").alias("_via"), F.col("child").alias("_next"))
        far = far.withColumnRenamed("child", "_via").join(on, ["recording", "_via"]).select("recording", "parent", F.col("_next").alias("child")).distinct()
        far = stage(far, "schema-jumps")


def _epochs(vers: DataFrame, needs: DataFrame, edges: DataFrame) -> DataFrame:
    """The registrations of each struct and of what it nests from its ``need`` on, distinct.

    Only those later than a struct's own ``need`` have to be handed to the structs that nest it; where no schema is
    registered twice there are none.
    """
    later = vers.join(needs, SCHEMA).filter("schema_seq > need").select(*EPOCH)
    found, some = stage_counted(later, "schema-epochs")
    own = needs.select(*SCHEMA, F.col("need").alias("schema_seq"))
    up = lambda rows, by: rows.withColumnRenamed("struct_name", "child").join(by.select("recording", "child", F.col("parent").alias("struct_name")), ["recording", "child"])
    new = lambda rows: rows.join(needs, SCHEMA).filter("schema_seq > need").select(*EPOCH).distinct()
    at_times = edges.filter("not always")
    if not some and at_times.isEmpty():
        return own
    fresh = up(found, edges).unionByName(up(own, at_times))
    while True:
        fresh, grown = stage_counted(new(fresh).join(found, EPOCH, "left_anti"), "schema-epochs")
        if not grown:
            return found.unionByName(own)
        found = found.unionByName(fresh)
        fresh = up(fresh, edges)


def _steps(children: DataFrame, vers: DataFrame) -> DataFrame:
    """What each nested type of a recording holds, by the span of registrations for which it does."""
    inner = vers.select(
        "recording", F.col("struct_name").alias("child"), F.col("schema_seq").alias("_from"), "until_seq",
        F.col("fields").alias("_inner"), F.col("incomplete").alias("_inner_bad"),
    )
    return children.withColumnRenamed("type", "_type").join(inner, ["recording", "child"])


def _leaf_rows(level: DataFrame, prim: Column, count: Column) -> DataFrame:
    fits = F.coalesce(count <= MAX_ELEMENTS, F.lit(True))
    return level.select(
        *EPOCH,
        "_order",
        F.array_append("_pieces", F.col("leaf_path")).alias("pieces"),
        F.col("_arrays").alias("arrays"),
        F.when(fits, prim).alias("prim"),
        F.when(fits, count.cast("bigint")).alias("count"),
        F.lit(None).cast("string").alias("missing"),
        F.when(F.col("_bad"), "incomplete schema").when(~fits, "layout too large").alias("problem"),
    )


def _flagged(level: DataFrame, missing: Column | None = None, problem: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    return level.select(
        *EPOCH,
        "_order",
        F.lit(None).cast("array<string>").alias("pieces"),
        F.lit(None).cast(ARRAYS).alias("arrays"),
        none.alias("prim"),
        F.lit(None).cast("bigint").alias("count"),
        (none if missing is None else missing).alias("missing"),
        (none if problem is None else problem).alias("problem"),
    )


def _descend(level: DataFrame, steps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Replace struct-typed fields by the fields of their type as of the same epoch."""
    current = (F.col("l.schema_seq") >= F.col("v._from")) & (F.col("l.schema_seq") < F.col("v.until_seq"))
    same = (F.col("l.recording") == F.col("v.recording")) & (F.col("l._f.type") == F.col("v._type"))
    hit = level.alias("l").join(steps.alias("v"), same & current, "left").select("l.*", "v.child", "v._inner", "v._inner_bad")
    hit = hit.withColumn("_loop", F.array_contains("_above", F.col("child")))
    count = F.col("_f.count")
    too_long = F.coalesce(count > MAX_ELEMENTS, F.lit(False))
    lost = hit.filter("_inner is null")
    looped = hit.filter((F.col("_inner").isNotNull()) & (F.col("_loop") | too_long))
    good = hit.filter((F.col("_inner").isNotNull()) & ~F.col("_loop") & ~too_long)
    found = (
        _flagged(lost, missing=F.col("_f.type"))
        .unionByName(_flagged(looped, problem=F.when(F.col("_loop"), "recursive struct").otherwise("layout too large")))
        .unionByName(
            _leaf_rows(
                good.filter(count.isNotNull()).withColumn("leaf_path", join_path(F.col("leaf_path"), F.lit("length"))),
                F.lit("length"),
                count,
            )
        )
    )
    single = count.isNull()
    here = F.struct(F.array_join(F.col("_order").cast("array<string>"), ".").alias("at"), count.alias("n"))
    deeper = good.select(
        *EPOCH,
        (F.col("_bad") | F.col("_inner_bad")).alias("_bad"),
        F.array_append("_above", F.col("child")).alias("_above"),
        "_order",
        F.when(single, F.col("leaf_path")).otherwise("").alias("_path"),
        F.when(single, F.col("_pieces")).otherwise(F.array_append("_pieces", F.col("leaf_path"))).alias("_pieces"),
        F.when(single, F.col("_arrays")).otherwise(F.array_append("_arrays", here)).alias("_arrays"),
        F.posexplode("_inner").alias("_pos", "_f"),
    )
    return deeper, found


def _times(counts: Column, start: Column) -> Column:
    """``start`` times all counts, stopped at ``TOO_LARGE``."""
    most = F.lit(TOO_LARGE).cast("bigint")
    return F.aggregate(counts, F.least(start, most), lambda size, a: F.least(size * a["n"], most))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _assemble(roots: DataFrame, leaves: DataFrame) -> DataFrame:
    """Offsets and strides from running sums over the declaration order, then one row per layout.

    ``_start`` sums the bytes of all earlier leaves, each with all elements that its arrays give it. What lies between the
    start of an array and a leaf in it belongs to every element alike, so its share of one element is that sum
    divided by the elements there are: no element is ever made.
    """
    long = lambda x: F.lit(x).cast("bigint")
    width = F.coalesce(F.try_element_at(literal_map(WIDTHS), F.col("prim")), F.lit(0)).cast("bigint")
    own = F.when(F.col("prim") == "length", long(0)).otherwise(width * F.coalesce("count", long(1)))
    before = Window.partitionBy(*EPOCH).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        leaves.withColumn("width", width.cast("int"))
        .withColumn("_total", F.when(F.col("prim").isNull(), long(0)).otherwise(_times(F.col("arrays"), own)))
        .withColumn("_start", F.coalesce(F.sum("_total").over(before), long(0)))
    )
    at = F.when(F.col("prim") == "length", F.array_join(F.col("_order").cast("array<string>"), ".")).alias("at")
    leaf = F.struct("_order", "_start", "_total", at, "arrays", "pieces", "prim", F.col("count").cast("int").alias("count"), "width")
    packed = placed.groupBy(*EPOCH).agg(
        F.sum("_total").alias("_size"),
        F.min("missing").alias("missing"),
        F.min("problem").alias("problem"),
        F.sort_array(F.collect_list(F.when(F.col("prim").isNotNull(), leaf))).alias("_leaves"),
    )

    def span(x: Column) -> Column:
        """Of an array, seen from its length leaf: where it starts, and the bytes of all its elements."""
        inside = F.filter("_leaves", lambda y: F.exists(y["arrays"], lambda a: a["at"] == x["at"]))
        return F.struct(x["at"], F.struct(x["_start"].alias("start"), F.aggregate(inside, long(0), lambda n, y: n + y["_total"]).alias("bytes")))

    spans = F.map_from_entries(F.transform(F.filter("_leaves", lambda x: x["prim"] == "length"), span))

    def offset(x: Column) -> Column:
        first = F.struct(long(0).alias("at"), long(0).alias("start"), long(1).alias("n"))

        def inward(state: Column, a: Column) -> Column:
            start = F.element_at(F.col("_spans"), a["at"])["start"]
            return F.struct(
                (state["at"] + _div(start - state["start"], state["n"])).alias("at"), start.alias("start"),
                F.least(state["n"] * a["n"], long(TOO_LARGE)).alias("n"),
            )

        return F.aggregate(x["arrays"], first, inward, lambda s: s["at"] + _div(x["_start"] - s["start"], s["n"]))

    def dims(x: Column) -> Column:
        elements = lambda i: _times(F.slice(x["arrays"], F.lit(1), i + 1), long(1))
        return F.transform(
            x["arrays"],
            lambda a, i: F.struct(a["n"].alias("n"), _div(F.element_at(F.col("_spans"), a["at"])["bytes"], elements(i)).alias("stride")),
        )

    bad = F.when(F.col("incomplete"), "incomplete schema")
    problem = F.coalesce(F.col("problem"), bad, F.when(F.col("_size") > MAX_ELEMENTS, "layout too large"))
    made = F.transform(
        "_leaves",
        lambda x: F.struct(offset(x).alias("offset"), x["pieces"].alias("pieces"), dims(x).alias("dims"), x["prim"].alias("prim"), x["count"].alias("count"), x["width"].alias("width")),
    )
    return roots.join(packed.withColumn("_spans", spans), EPOCH, "left").select(
        *EPOCH,
        F.col("missing").isNull().alias("complete"),
        "missing",
        problem.alias("problem"),
        F.coalesce(F.col("_size"), long(0)).alias("struct_size"),
        F.when(problem.isNull() & F.col("_leaves").isNotNull(), made).otherwise(F.array().cast(LEAVES)).cast(LEAVES).alias("leaves"),
    )


def element_place(pieces: Column, dims: Column, index: Column) -> Column:
    """(path, at) of element ``index`` of a leaf, elements counted in byte order: ``at`` is relative to the leaf's offset."""
    last = F.struct(index.cast("bigint").alias("rest"), F.lit(0).cast("bigint").alias("at"), F.element_at(pieces, -1).alias("path"))

    def outward(state: Column, k: Column) -> Column:
        dim = F.element_at(dims, k)
        i = state["rest"] % dim["n"]
        path = F.concat_ws("/", F.element_at(pieces, k), i.cast("string"), F.nullif(state["path"], F.lit("")))
        return F.struct(_div(state["rest"], dim["n"]).alias("rest"), (state["at"] + i * dim["stride"]).alias("at"), path.alias("path"))

    far = F.aggregate(F.reverse(F.sequence(F.lit(1), F.size(dims))), last, outward)
    none = F.struct(F.element_at(pieces, -1).alias("path"), F.lit(0).cast("bigint").alias("at"))
    return F.when(F.size(dims) == 0, none).otherwise(F.struct(far["path"].alias("path"), far["at"].alias("at")))


def elements(dims: Column) -> Column:
    return F.aggregate(dims, F.lit(1).cast("bigint"), lambda n, d: n * d["n"])


def with_elements(rows: DataFrame, pieces: str = "pieces", dims: str = "dims") -> DataFrame:
    """A row per element of the leaf that each row holds, with its ``path`` and ``at``; no array above ``CHUNK`` is made for it."""
    long = lambda x: F.lit(x).cast("bigint")
    some = rows.withColumn("_n", elements(F.col(dims))).withColumn("_first", F.explode(F.sequence(long(0), F.col("_n") - 1, long(CHUNK))))
    each = some.withColumn("_element", F.explode(F.sequence(F.col("_first"), F.least(F.col("_first") + (CHUNK - 1), F.col("_n") - 1))))
    return each.withColumn("_place", element_place(F.col(pieces), F.col(dims), F.col("_element"))).select(
        *rows.columns, F.col("_place.path").alias("path"), F.col("_place.at").alias("at")
    )


def leaf_elements(layouts: DataFrame) -> DataFrame:
    """Every leaf of the usable layouts, element by element: (EPOCH, struct_size, leaf_path, prim, offset, count)."""
    leaf = layouts.filter("complete and problem is null").select(*EPOCH, "struct_size", F.explode("leaves").alias("leaf"))
    rows = leaf.select(*EPOCH, "struct_size", "leaf.*")
    return with_elements(rows).select(*EPOCH, "struct_size", F.col("path").alias("leaf_path"), "prim", (F.col("offset") + F.col("at")).alias("offset"), "count")


def struct_layout(layouts: DataFrame) -> DataFrame:
    """Long view of the complete layouts, one row per leaf element that holds bytes.

    Arrays of structs have a row per element here; ``layouts`` holds them without.
    """
    return leaf_elements(layouts).filter("prim <> 'length'").select(
        *EPOCH, "leaf_path", "prim", F.col("offset").cast("int").alias("offset"), "count", F.col("struct_size").cast("int").alias("struct_size"),
    )


def _code(kind: Column) -> Column:
    return F.try_element_at(literal_map(CODE), kind)


def leaf_cells(layouts: DataFrame) -> DataFrame:
    """What one record of a struct turns into: (pieces, dims, code, offset, width, n), a row per leaf.

    Primitive arrays are a leaf with one dimension more and a ``length``; rows with ``is_length``
    stand for the length of an array of the struct itself. Leaves of up to ``SPREAD`` elements are a row per element, without
    ``dims``; ``with_elements`` makes the elements of the others where there is a record that holds them.
    """
    usable = layouts.filter("complete and problem is null").select(
        "recording", "struct_name", F.col("schema_seq").alias("epoch"), F.explode("leaves").alias("leaf")
    )
    prim, count, pieces = F.col("leaf.prim"), F.col("leaf.count"), F.col("leaf.pieces")
    many = count.isNotNull() & ~prim.isin("length", "char")
    is_count = (prim == "length") | (many & F.col("_length"))
    longer = F.concat(F.slice(pieces, 1, F.size(pieces) - 1), F.array(join_path(F.element_at(pieces, -1), F.lit("length"))))
    dim = F.struct(count.cast("bigint").alias("n"), F.col("leaf.width").cast("bigint").alias("stride"))
    kind = F.when(is_count, "length").when((prim == "char") & count.isNotNull(), "char[]").when(prim == "bool", "boolean").otherwise(prim)
    spread = usable.withColumn("_length", F.explode(F.when(many, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(False))))).select(
        "recording",
        "struct_name",
        "epoch",
        F.lit(False).alias("is_length"),
        F.when(many & F.col("_length"), longer).when(many, F.array_append(pieces, F.lit(""))).otherwise(pieces).alias("pieces"),
        F.when(many & ~F.col("_length"), F.array_append("leaf.dims", dim)).otherwise(F.col("leaf.dims")).cast(DIMS).alias("dims"),
        _code(kind).alias("code"),
        F.col("leaf.offset").cast("int").alias("offset"),
        F.when(is_count, 0).when(prim == "char", F.coalesce(count, F.lit(1))).otherwise(F.col("leaf.width")).alias("width"),
        F.when(is_count, count).cast("bigint").alias("n"),
    )
    own_length = layouts.filter("complete and problem is null").select(
        "recording", "struct_name", F.col("schema_seq").alias("epoch"), F.lit(True).alias("is_length"), F.array(F.lit("length")).alias("pieces"),
        F.array().cast(DIMS).alias("dims"), F.lit(CODE["length"]).alias("code"), F.lit(0).alias("offset"), F.lit(0).alias("width"), F.lit(None).cast("bigint").alias("n"),
    )
    rows = spread.unionByName(own_length).withColumn("_few", elements(F.col("dims")) <= SPREAD)
    few = with_elements(rows.filter("_few")).withColumn("offset", (F.col("offset") + F.col("at")).cast("int")).withColumn("pieces", F.array("path"))
    few = few.withColumn("dims", F.array().cast(DIMS))
    return few.select(*spread.columns).unionByName(rows.filter("not _few").select(*spread.columns))
