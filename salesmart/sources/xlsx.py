"""Excel workbook (.xlsx) source.

Spark has no built-in xlsx reader and no connector jar is available, so a
workbook scan is composed from Spark parts: the built-in ``binaryFile``
source lists and reads the files (any Hadoop path, glob, partition
discovery; one row per workbook, spread over tasks), and ``mapInArrow``
parses each workbook inside its task — the sheet XML is streamed with
expat and rows leave the task in Arrow batches.  A workbook is the
unit of parallelism (a zip container is not splittable); land many
workbooks to read in parallel.

Options follow the connector the original pipeline used:
``address``       ``'Sheet name'!A1`` — sheet by name, top-left cell of
                  the table (default ``'Worksheet'!A1``).
``header``        first row of the table holds column names (skipped; the
                  fixed schema binds columns by position).
``empty_as_null`` empty cell text becomes NULL.
Numbers read into string fields are rendered as the sheet shows them (see
``number_formats``): by the cell's number format, and in plain notation (``1234``
not ``1234.0`` or ``1.234E3``, 15 significant digits) where it has none.  Every
row that has cells is kept, also where they are blank; the rules decide about it.
"""

from __future__ import annotations

import datetime as _dt
import io
import posixpath
import re
import zipfile
from collections.abc import Callable
from decimal import Decimal, InvalidOperation
from functools import lru_cache
from xml.etree.ElementTree import iterparse
from xml.parsers import expat

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesmart.sources import number_formats

DEFAULT_ADDRESS = "'Worksheet'!A1"
BATCH_ROWS = 8192
_CELL_REF = re.compile(r"^([A-Z]+)([0-9]+)$")
_EXCEL_EPOCH = _dt.datetime(1899, 12, 30)


def parse_address(address: str) -> tuple[str | None, int, int]:
    """``'My Sheet'!B3`` -> ("My Sheet", col 1, row 3) (col 0-based, row 1-based)."""

    sheet, cell = None, address or "A1"
    if "!" in cell:
        sheet, cell = cell.rsplit("!", 1)
        if sheet.startswith("'") and sheet.endswith("'"):
            sheet = sheet[1:-1].replace("''", "'")
    m = _CELL_REF.match(cell.replace("$", "").upper())
    if not m:
        raise ValueError(f"Bad data address: {address!r}")
    return sheet, column_index(m.group(1)), int(m.group(2))


def column_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _attr(elem, name: str):
    for key, value in elem.attrib.items():
        if _local(key) == name:
            return value
    return None


def _expat_feed(fh, parser, drain=None, chunk=1 << 16):
    """Feed a binary stream to an expat parser chunk by chunk; after every
    chunk call ``drain`` (which yields what the handlers completed)."""

    while True:
        data = fh.read(chunk)
        parser.Parse(data, not data)
        if drain is not None:
            yield from drain()
        if not data:
            return


def _local_names():
    cache: dict[str, str] = {}

    def local(name: str) -> str:
        got = cache.get(name)
        if got is None:
            got = cache[name] = name.rsplit(":", 1)[-1]
        return got

    return local


def _shared_strings(zf: zipfile.ZipFile) -> list[str]:
    """The shared string table: text of every ``<si>`` (rich-text runs
    joined, phonetic ``<rPh>`` runs left out)."""

    if "xl/sharedStrings.xml" not in zf.namelist():
        return []
    out: list[str] = []
    parts: list[str] = []
    local = _local_names()
    state = {"in_t": False, "phonetic": 0}
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(name, attrs):
        tag = local(name)
        if tag == "t" and not state["phonetic"]:
            state["in_t"] = True
        elif tag == "rPh":
            state["phonetic"] += 1

    def end(name):
        tag = local(name)
        if tag == "t":
            state["in_t"] = False
        elif tag == "rPh":
            state["phonetic"] -= 1
        elif tag == "si":
            out.append("".join(parts))
            parts.clear()

    def text(data):
        if state["in_t"]:
            parts.append(data)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, text
    with zf.open("xl/sharedStrings.xml") as fh:
        for _ in _expat_feed(fh, parser):
            pass
    return out


def _sheet_member(zf: zipfile.ZipFile, sheet: str | None) -> str:
    with zf.open("xl/workbook.xml") as fh:
        sheets = [(_attr(e, "name"), _attr(e, "id")) for _, e in iterparse(fh) if _local(e.tag) == "sheet"]
    if not sheets:
        raise ValueError("Workbook has no sheets")
    if sheet is None:
        rid = sheets[0][1]
    else:
        match = [rid for name, rid in sheets if name == sheet]
        if not match:
            raise ValueError(f"Unknown sheet {sheet!r}; workbook has {[n for n, _ in sheets]}")
        rid = match[0]
    with zf.open("xl/_rels/workbook.xml.rels") as fh:
        targets = {_attr(e, "Id"): _attr(e, "Target") for _, e in iterparse(fh) if _local(e.tag) == "Relationship"}
    target = targets[rid]
    return target.lstrip("/") if target.startswith("/") else posixpath.normpath(posixpath.join("xl", target))


def plain_number(text: str, zeros: int = 0) -> str:
    """A stored number in plain notation, a whole one with at least ``zeros``
    digits (a format such as ``00000``)."""

    plain = number_formats.plain_number(text)
    if zeros and re.fullmatch("-?[0-9]+", plain):
        return "-" * plain.startswith("-") + plain.lstrip("-").zfill(zeros)
    return plain


def _cell_formats(zf: zipfile.ZipFile) -> Callable[[int], Callable[[str], str]]:
    """Cell style -> the function that shows a number in its format (compiled
    when a cell first has the style)."""

    codes, styles, inside = dict(number_formats.BUILT_IN), [], False
    if "xl/styles.xml" in zf.namelist():
        with zf.open("xl/styles.xml") as fh:
            for event, e in iterparse(fh, events=("start", "end")):
                tag = _local(e.tag)
                if tag == "cellXfs":
                    inside = event == "start"
                elif event == "start" and tag == "numFmt":
                    codes[int(_attr(e, "numFmtId"))] = _attr(e, "formatCode")
                elif event == "start" and tag == "xf" and inside:
                    styles.append(int(_attr(e, "numFmtId") or 0))

    @lru_cache(maxsize=None)  # a workbook has at most 65,490 styles
    def of(style: int) -> Callable[[str], str]:
        return number_formats.formatter(codes.get(styles[style]) if style < len(styles) else None)

    return of


def iter_sheet_rows(zf: zipfile.ZipFile, sheet: str | None):
    """Yield (row_number, {col_index: cell}) for every row of a sheet that has
    cells; a cell is its text, None, or (stored, displayed) for a number.

    A streaming expat scan: no element tree is built, memory holds the rows
    of one 64 KiB chunk at most.
    """

    strings = _shared_strings(zf)
    shown = _cell_formats(zf)
    member = _sheet_member(zf, sheet)
    local = _local_names()
    done: list[tuple[int, dict]] = []
    st = {"row": 0, "next": 1, "cells": {}, "col": 0, "style": 0, "type": None, "value": None, "capture": False}
    buf: list[str] = []
    inline: list[str] = []
    parser = expat.ParserCreate()
    parser.buffer_text = True

    def start(name, attrs):
        tag = local(name)
        if tag == "c":
            ref = attrs.get("r")
            m = _CELL_REF.match(ref) if ref else None
            st["col"] = column_index(m.group(1)) if m else len(st["cells"])
            st["type"], st["value"], st["style"] = attrs.get("t"), None, int(attrs.get("s") or 0)
            inline.clear()
        elif tag == "v" or (tag == "t" and st["type"] == "inlineStr"):
            st["capture"] = True
            buf.clear()
        elif tag == "row":
            r = attrs.get("r")
            st["row"] = int(r) if r else st["next"]
            st["cells"] = {}

    def end(name):
        tag = local(name)
        if tag == "v":
            st["value"], st["capture"] = "".join(buf), False
        elif tag == "t" and st["capture"]:
            inline.append("".join(buf))
            st["capture"] = False
        elif tag == "c":
            kind, value = st["type"], st["value"]
            if kind == "s":
                text = strings[int(value)] if value is not None else None
            elif kind == "inlineStr":
                text = "".join(inline)
            elif kind == "b":
                text = None if value is None else ("TRUE" if value.strip() == "1" else "FALSE")
            elif kind == "e":
                text = None
            elif kind in ("str", "d"):
                text = value
            else:
                text = None if value is None else (value, shown(st["style"])(value))
            st["cells"][st["col"]] = text
        elif tag == "row":
            if st["cells"]:  # a row that has cells is a row of the table, blank or not
                done.append((st["row"], st["cells"]))
            st["next"] = st["row"] + 1

    def chars(data):
        if st["capture"]:
            buf.append(data)

    def drain():
        rows = list(done)
        done.clear()
        return rows

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars
    with zf.open(member) as fh:
        yield from _expat_feed(fh, parser, drain)


def _converter(data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return lambda s: s
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        def to_int(s):
            try:
                d = Decimal(s)
            except InvalidOperation:
                return None
            return int(d) if d == d.to_integral_value() else None
        return to_int
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        def to_float(s):
            try:
                return float(s)
            except ValueError:
                return None
        return to_float
    if isinstance(data_type, T.DecimalType):
        def to_dec(s):
            try:
                return Decimal(s)
            except InvalidOperation:
                return None
        return to_dec
    if isinstance(data_type, T.BooleanType):
        return lambda s: {"TRUE": True, "1": True, "FALSE": False, "0": False}.get(s.strip().upper())
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        want_date = isinstance(data_type, T.DateType)

        def to_time(s):
            try:
                value = _EXCEL_EPOCH + _dt.timedelta(days=float(s))
            except ValueError:
                try:
                    value = _dt.datetime.fromisoformat(s)
                except ValueError:
                    return None
            return value.date() if want_date else value
        return to_time
    raise TypeError(f"xlsx reader does not support {data_type.simpleString()}")


def workbook_rows(content: bytes, schema: T.StructType, address: str = DEFAULT_ADDRESS,
                  header: bool = True, empty_as_null: bool = True):
    """Typed row tuples of one workbook (bytes), bound to ``schema`` by position."""

    sheet, first_col, first_row = parse_address(address)
    converters = [_converter(f.dataType) for f in schema.fields]
    as_text = [isinstance(f.dataType, T.StringType) for f in schema.fields]
    width = len(converters)
    header_pending = header
    with zipfile.ZipFile(io.BytesIO(content)) as zf:
        for row_no, cells in iter_sheet_rows(zf, sheet):
            if row_no < first_row:
                continue
            if header_pending:
                header_pending = False
                continue
            found = [cells.get(first_col + i) for i in range(width)]
            # a number cell is (stored text, displayed text): string fields get what the sheet shows
            texts = [(t[1] if shown else t[0]) if isinstance(t, tuple) else t for t, shown in zip(found, as_text)]
            if empty_as_null:
                texts = [None if t == "" else t for t in texts]
            yield tuple(None if t is None else conv(t) for conv, t in zip(converters, texts))


def read_xlsx(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    address: str = DEFAULT_ADDRESS,
    header: bool = True,
    empty_as_null: bool = True,
) -> DataFrame:
    """Read workbooks at ``path`` (file, directory or glob) with a fixed schema."""

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow_schema = to_arrow_schema(schema)
    parse_address(address)  # fail fast on a bad address

    def parse(batches):
        for batch in batches:
            contents = batch.column("content")
            for i in range(batch.num_rows):
                content = contents[i].as_py()  # one workbook in Python memory at a time
                rows = []
                for row in workbook_rows(content, schema, address, header, empty_as_null):
                    rows.append(row)
                    if len(rows) >= BATCH_ROWS:
                        yield _to_batch(rows, arrow_schema, pa)
                        rows = []
                if rows:
                    yield _to_batch(rows, arrow_schema, pa)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, schema)


def _to_batch(rows, arrow_schema, pa):
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(list(col), type=field.type) for col, field in zip(columns, arrow_schema)],
        schema=arrow_schema,
    )


# ---------------------------------------------------------------------------
# Fixture helper: a minimal workbook writer (tests and round-trip checks).
# ---------------------------------------------------------------------------

def _xml_text(s: str) -> str:
    return s.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def _col_letters(i: int) -> str:
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_workbook(fh, header: list[str], row_batches, sheet: str = "Worksheet") -> int:
    """Stream a one-sheet workbook to the binary file ``fh``: rows come in
    batches and are written as they arrive (inline strings, so no string
    table has to be held in memory).  Returns the number of data rows."""

    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    n = 0
    with zipfile.ZipFile(fh, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in _package_parts(sheet, with_shared_strings=False).items():
            zf.writestr(name, text)
        with zf.open("xl/worksheets/sheet1.xml", "w") as out:
            out.write(f'<?xml version="1.0" encoding="UTF-8"?><worksheet {ns}><sheetData>'.encode())
            out.write(_row_xml(1, header, inline=True, shared=None).encode("utf-8"))
            for batch in row_batches:
                for values in batch:
                    n += 1
                    out.write(_row_xml(n + 1, values, inline=True, shared=None).encode("utf-8"))
            out.write(b"</sheetData></worksheet>")
    return n


def _cell_xml(ref: str, v, inline: bool, shared: dict | None) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float, Decimal)):
        return f'<c r="{ref}"><v>{v}</v></c>'
    v = str(v)
    if inline:
        return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{_xml_text(v)}</t></is></c>'
    idx = shared.setdefault(v, len(shared))
    return f'<c r="{ref}" t="s"><v>{idx}</v></c>'


def _row_xml(r: int, values, inline: bool, shared: dict | None) -> str:
    cells = "".join(_cell_xml(f"{_col_letters(c)}{r}", v, inline, shared) for c, v in enumerate(values))
    return f'<row r="{r}">{cells}</row>'


def _package_parts(sheet: str, with_shared_strings: bool) -> dict[str, str]:
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sst_type = '<Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/>'
    sst_rel = '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/sharedStrings" Target="sharedStrings.xml"/>'
    return {
        "[Content_Types].xml": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
            '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
            + (sst_type if with_shared_strings else "") + "</Types>"
        ),
        "_rels/.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/>'
            "</Relationships>"
        ),
        "xl/workbook.xml": (
            f'<?xml version="1.0" encoding="UTF-8"?><workbook {ns} {rns}><sheets>'
            f'<sheet name="{_xml_text(sheet)}" sheetId="1" r:id="rId1"/></sheets></workbook>'
        ),
        "xl/_rels/workbook.xml.rels": (
            '<?xml version="1.0" encoding="UTF-8"?>'
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/>'
            + (sst_rel if with_shared_strings else "") + "</Relationships>"
        ),
    }


def workbook_bytes(header: list[str], rows, sheet: str = "Worksheet", inline_strings: bool = False) -> bytes:
    """A one-sheet workbook; str cells as shared (or inline) strings, numbers
    as numeric cells, None as a missing cell."""

    shared: dict[str, int] = {}
    body = "".join(_row_xml(r, values, inline_strings, shared) for r, values in enumerate([header, *rows], start=1))
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    files = _package_parts(sheet, with_shared_strings=True)
    files["xl/worksheets/sheet1.xml"] = (
        f'<?xml version="1.0" encoding="UTF-8"?><worksheet {ns}><sheetData>{body}</sheetData></worksheet>'
    )
    sst = "".join(f'<si><t xml:space="preserve">{_xml_text(s)}</t></si>' for s in shared)
    files["xl/sharedStrings.xml"] = (
        f'<?xml version="1.0" encoding="UTF-8"?><sst {ns} count="{len(shared)}" uniqueCount="{len(shared)}">{sst}</sst>'
    )
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, text in files.items():
            zf.writestr(name, text)
    return buf.getvalue()
