"""Figures from article XML.

X1 is the one place where Python parses per row: article XML is not a shape
Spark's ``xpath_*`` can take safely (it aborts on malformed input, tries to
fetch DTDs and fails on undeclared entities).  The parse runs in
``mapInArrow`` over Arrow batches; every other step is Spark expressions.

Parser contract (our own definition):

* every ``fig`` element at any depth, in document order (``fig_pos`` 0..);
* ``fig_id`` = its ``id`` attribute; ``fig_label`` = the text of its ``label``
  child;
* ``fig_caption`` = the texts of the ``caption`` element's child elements
  (each with all nested text) joined by one space, or the caption's own text
  when it has no child elements;
* ``graphic_ref`` = the ``href`` attribute (any namespace) of the direct
  ``graphic`` child, NULL if there is none;
* ``pmid`` / ``pmc`` = text of the first ``article-id`` whose ``pub-id-type``
  is ``pmid`` / ``pmc``;
* the declared encoding is followed; named HTML entities are accepted, CDATA is
  left as it is; external DTDs are never fetched;
* a document is read once, in events; finished elements are dropped, so memory
  follows its figures, not its size;
* a document that does not parse gives ``parse_error`` and no figures.
"""

from __future__ import annotations

import html.entities
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from figpairs.functions.text import nonempty_or, parent_dir
from figpairs.schemas import FIGURE, INLINE_REF

PARSE_BYTES = 1 << 20


class _Figure:
    """A ``fig`` element that is still open: its record, and the label or caption that is being read."""

    def __init__(self, depth: int, record: dict):
        self.depth, self.record = depth, record
        self.part: str | None = None
        self.part_depth = 0
        self.own: list[str] = []
        self.kids: list[list[str]] = []

    def start(self, depth: int, name: str, attrs: dict) -> None:
        if self.part:
            if self.part == "fig_caption" and depth == self.part_depth + 1:
                self.kids.append([])
        elif depth == self.depth + 1:
            part = {"label": "fig_label", "caption": "fig_caption"}.get(name)
            if part and self.record[part] is None:
                self.part, self.part_depth, self.own, self.kids = part, depth, [], []
            elif name == "graphic" and self.record["graphic_ref"] is None:
                self.record["graphic_ref"] = next((v for k, v in attrs.items() if _local(k) == "href"), None)

    def text(self, depth: int, data: str) -> None:
        if self.part == "fig_label":
            self.own.append(data)
        elif self.part and depth > self.part_depth:
            self.kids[-1].append(data)
        elif self.part and not self.kids:
            self.own.append(data)

    def end(self, depth: int) -> None:
        if self.part and depth == self.part_depth:
            self.record[self.part] = " ".join("".join(k) for k in self.kids) if self.kids else "".join(self.own)
            self.part = None


class ArticleReader:
    """Figures of an article, fed in chunks; only open figures and what was found are held.

    The declared encoding is followed, named HTML entities are known, DTDs are
    not fetched.  Tags and attribute names in a namespace come as ``uri}name``.
    """

    def __init__(self, encoding: str | None = None):
        self.figures: list[dict] = []
        self.ids: dict[str, list[str]] = {}
        self.open: list[_Figure] = []
        self.id_text: tuple[int, list[str]] | None = None
        self.depth = 0
        p = self.parser = expat.ParserCreate(encoding, namespace_separator="}")
        p.buffer_text = True
        p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = self.start, self.end, self.text
        p.UseForeignDTD(True)  # else an entity that no DTD declares ends the parse
        p.ExternalEntityRefHandler = lambda *_: 1
        p.SkippedEntityHandler = self.entity

    def start(self, tag: str, attrs: dict) -> None:
        self.depth += 1
        self.id_text = None  # an id's text ends with its first child
        name = _local(tag)
        for f in self.open:
            f.start(self.depth, name, attrs)
        if name == "article-id" and (kind := attrs.get("pub-id-type")) in ("pmid", "pmc") and kind not in self.ids:
            self.ids[kind] = []
            self.id_text = self.depth, self.ids[kind]
        elif name == "fig":
            record = {"fig_pos": len(self.figures), "pmid": None, "pmc": None, "fig_id": attrs.get("id"), "fig_label": None,
                      "fig_caption": None, "graphic_ref": None, "fig_refs": []}
            self.figures.append(record)
            self.open.append(_Figure(self.depth, record))

    def text(self, data: str) -> None:
        if self.id_text:
            self.id_text[1].append(data)
        for f in self.open:
            f.text(self.depth, data)

    def end(self, tag: str) -> None:
        self.id_text = None
        for f in self.open:
            f.end(self.depth)
        if self.open and self.open[-1].depth == self.depth:
            self.open.pop()
        self.depth -= 1

    def entity(self, name: str, is_parameter: bool) -> None:
        if not is_parameter:
            if name not in html.entities.name2codepoint:
                raise expat.ExpatError(f"undefined entity &{name};")
            self.text(chr(html.entities.name2codepoint[name]))

    def feed(self, data: bytes, last: bool) -> str | None:
        """An error, or None."""
        try:
            self.parser.Parse(data, last)
        except expat.ExpatError as e:
            return f"xml_syntax: {e}"
        except Exception as e:  # noqa: BLE001 - recorded per row, never raised
            return f"parse_other: {type(e).__name__}"
        return None

    def found(self) -> list[dict]:
        ids = {k: "".join(v) for k, v in self.ids.items()}
        return [r | {"pmid": ids.get("pmid"), "pmc": ids.get("pmc")} for r in self.figures]


def _local(tag) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def parse_figures_xml(data) -> tuple[list[dict], str | None]:
    """Parse one article (text, bytes, or an open file, read in chunks); returns (figures, error)."""
    if data is None:
        return [], "no_xml"
    reader = ArticleReader("utf-8" if isinstance(data, str) else None)
    if hasattr(data, "read"):
        error = None
        while error is None and (chunk := data.read(PARSE_BYTES)):  # a failed read is the caller's
            error = reader.feed(chunk, False)
        error = error or reader.feed(b"", True)
    else:
        error = reader.feed(data.encode() if isinstance(data, str) else bytes(data), True)
    return ([], error) if error else (reader.found(), None)


def _parse_batches(xml_col: str, out_schema: pa.Schema):
    fig_type = out_schema.field("figures").type

    def fn(batches):
        for b in batches:
            figs_out, errs = [], []
            for v in b.column(xml_col).to_pylist():
                figs, err = parse_figures_xml(v)
                figs_out.append(figs)
                errs.append(err)
            cols = [b.column(n) for n in out_schema.names if n not in ("figures", "parse_error")]
            cols += [pa.array(figs_out, type=fig_type), pa.array(errs, type=pa.string())]
            yield pa.RecordBatch.from_arrays(cols, schema=out_schema)

    return fn


def extract_figures(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Add ``figures ARRAY<FIGURE>`` and ``parse_error``; the XML column is dropped."""
    keep = [f for f in df.schema.fields if f.name != xml_col]
    spark_schema = T.StructType(keep + [T.StructField("figures", T.ArrayType(FIGURE)), T.StructField("parse_error", T.StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(spark_schema)
    src = df.select(*[f.name for f in keep], xml_col)
    return src.mapInArrow(_parse_batches(xml_col, arrow_schema), spark_schema)


def parsed_ok(df: DataFrame) -> DataFrame:
    """Articles that parsed and have at least one figure."""
    return df.filter(F.col("parse_error").isNull() & (F.size("figures") > 0))


def flatten_figures(df: DataFrame, figures_col: str = "figures") -> DataFrame:
    """One row per figure; ``fig_pos`` keeps the order in the article."""
    others = [c for c in df.columns if c != figures_col]
    return df.select(*others, F.inline(figures_col))


def with_article_ids(df: DataFrame, figures_col: str = "figures", cat_pmid: str = "pmid", cat_pmcid: str = "pmcid") -> DataFrame:
    """article ``pmid``/``pmcid`` from the first figure, else the catalogue's."""
    first = F.get(F.col(figures_col), 0)
    return df.withColumn(cat_pmid, nonempty_or(first["pmid"], F.col(cat_pmid))).withColumn(
        cat_pmcid, nonempty_or(first["pmc"], F.col(cat_pmcid))
    )


def inline_ref_violations(df: DataFrame, figures_col: str = "figures") -> DataFrame:
    """the rows on which the strict mode of :func:`normalise_inline_refs` aborts, with their number of references."""
    n = F.aggregate(F.transform(figures_col, lambda f: F.greatest(F.coalesce(F.size(f["fig_refs"]), F.lit(0)), F.lit(0))), F.lit(0), lambda a, b: a + b)
    return df.withColumn("n_refs", n).filter(F.col("n_refs") > 0)


def normalise_inline_refs(df: DataFrame, figures_col: str = "figures", strict: bool = False) -> DataFrame:
    """cast inline references to strings; in strict mode any reference aborts
    the job (the source raises "not implemented"); otherwise they are dropped."""
    refs_t = T.ArrayType(INLINE_REF)

    def norm(f):
        refs = F.coalesce(f["fig_refs"], F.array().cast(refs_t))
        refs = F.transform(refs, lambda r: F.struct(*[F.coalesce(r[k].cast("string"), F.lit("")).alias(k) for k in ("text", "section", "reference_id")]))
        if strict:
            refs = F.when(F.size(refs) > 0, F.raise_error(F.lit("inline references are not supported"))).otherwise(refs)
        return f.withField("fig_refs", refs)

    out = df.withColumn(figures_col, F.transform(F.col(figures_col), norm))
    return out.withColumn(figures_col, F.transform(F.col(figures_col), lambda f: f.dropFields("fig_refs")))


def to_articles(df: DataFrame, path_col: str = "path", figures_col: str = "figures") -> DataFrame:
    """article records ``pmid, pmc, location, figures[]`` from parsed rows.

    ``location`` is the XML file's folder; a figure's ``graphic_ref`` becomes
    ``location/<ref>.jpg`` (``''`` when it has none) and ``pair_id`` is
    ``pmid_figid``.  A narrow ``transform`` — no shuffle.
    """
    first = F.get(F.col(figures_col), 0)
    loc = F.regexp_replace(parent_dir(path_col), "^file:/+", "/")  # a plain path, as file scans give URIs
    pmid = first["pmid"]

    def fig(f):
        ref = F.when(f["graphic_ref"].isNull(), F.lit("")).otherwise(F.concat(loc, F.lit("/"), f["graphic_ref"], F.lit(".jpg")))
        return F.struct(
            F.coalesce(f["fig_caption"], F.lit("")).alias("fig_caption"),
            F.coalesce(f["fig_id"], F.lit("")).alias("fig_id"),
            F.coalesce(f["fig_label"], F.lit("")).alias("fig_label"),
            ref.alias("graphic_ref"),
            F.concat(F.coalesce(pmid, F.lit("")), F.lit("_"), F.coalesce(f["fig_id"], F.lit(""))).alias("pair_id"),
        )

    return df.select(pmid.alias("pmid"), first["pmc"].alias("pmc"), loc.alias("location"), F.transform(F.col(figures_col), fig).alias("figures"))
