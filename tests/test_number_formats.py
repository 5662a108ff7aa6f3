"""What a sheet shows for a stored number, by format code."""

import io
import re
import zipfile

import pytest
from pyspark.sql import types as T

from salesmart.sources import number_formats
from salesmart.sources.number_formats import formatter
from salesmart.sources.xlsx import read_xlsx, workbook_bytes

DAY = "45322.5642361111"  # 31 January 2024, 13:32:30

CASES = [
    ("General", "1234.0", "1234"), ("General", "1.5E3", "1500"), ("General", "0.1", "0.1"), ("@", "12", "12"), (None, "-0.25", "-0.25"),
    ("0", "12.5", "13"), ("0", "-12.5", "-13"), ("0", "0.4", "0"), ("0", "-0.4", "0"), ("00000", "1234", "01234"), ("00000", "-7", "-00007"),
    ("0.00", "1.005", "1.01"), ("0.00", "3", "3.00"), ("#.##", "0.5", ".5"), ("#.##", "3", "3."), ("0.0#", "2.25", "2.25"), ("0.0#", "2.2", "2.2"),
    ("#,##0", "1234567.4", "1,234,567"), ("#,##0", "0", "0"), ("#,##0.00", "-1234.5", "-1,234.50"), ("#,###", "0", ""), ("#,##0,", "1234567", "1,235"), ("0.0,,", "1234567", "1.2"),
    ("0%", "0.256", "26%"), ("0.00%", "0.12345", "12.35%"), ("0%", "-0.5", "-50%"), ("0.00E+00", "12345", "1.23E+04"), ("0.00E+00", "0.00012", "1.20E-04"), ("0.0E+00", "9.96", "1.0E+01"), ("##0.0E+0", "12345", "12.3E+3"),
    ('"$"#,##0.00', "1234.5", "$1,234.50"), ("[$€-407] 0.00", "2", "€ 2.00"), (r"0\ \k\g", "5", "5 kg"), ('0.0" cm"', "1.25", "1.3 cm"), ("_(0_)", "5", " 5 "), ("*-0", "5", "5"), ("[Red]0", "5", "5"),
    ("#,##0;(#,##0)", "-1234", "(1,234)"), ('0;-0;"none"', "0", "none"), ('0;-0;"none"', "-3", "-3"), ("0;;", "-3", ""), ('0;"minus "0', "-3", "minus 3"),
    ("000-00-0000", "123456789", "123-45-6789"), ("000-00-0000", "1234", "000-00-1234"), ("(000) 000-0000", "4155550123", "(415) 555-0123"),
    ("m/d/yy", DAY, "1/31/24"), ("d/m/yyyy", DAY, "31/1/2024"), ("dd-mmm-yyyy", DAY, "31-Jan-2024"), ("dddd, mmmm d", DAY, "Wednesday, January 31"), ("ddd mmmmm", DAY, "Wed J"), ("dd.mm.yyyy", DAY, "31.01.2024"), ("yyyy\\-mm\\-dd", DAY, "2024-01-31"),
    ("h:mm", DAY, "13:32"), ("h:mm AM/PM", DAY, "1:32 PM"), ("hh:mm:ss", DAY, "13:32:30"), ("m/d/yy h:mm", DAY, "1/31/24 13:32"), ("mm:ss.0", DAY, "32:30.0"), ("[h]:mm", "1.5", "36:00"), ("[mm]:ss", "0.5", "720:00"), ("yyyy", "1", "1899"),
    ("# ?/?", "0.5", "0.5"), ("[<100]0;0.0", "5.5", "5.5"), ("m/d/yy", "-3", "-3"), ("m/d/yy", "9E9", "9000000000"), ("0", "text", "text"), ("0", "NaN", "NaN"), ("0.000000", "1E-7", "0.000000"), ("0", "1E20", "100000000000000000000"),
]


@pytest.mark.parametrize("code,stored,shown", CASES)
def test_shown(code, stored, shown):
    assert formatter(code)(stored) == shown


def test_every_built_in_format_shows_something():
    for code in number_formats.BUILT_IN.values():
        assert formatter(code)("12.5")


def test_string_columns_get_what_the_sheet_shows(spark, tmp_path):
    """Numeric columns get the stored number, whatever its format."""

    codes = ["General", "yyyy-mm-dd", "0.0%", "#,##0.00", "00000"]
    made = io.BytesIO(workbook_bytes(["a", "b", "c", "d", "e", "f"], [[7, 45322, 0.256, 1234.5, 42, 45322]]))
    styles = '<styleSheet><numFmts>' + "".join(f'<numFmt numFmtId="{170 + k}" formatCode="{c}"/>' for k, c in enumerate(codes)) + "</numFmts><cellXfs>"
    styles += "".join(f'<xf numFmtId="{170 + k}"/>' for k in range(len(codes))) + "</cellXfs></styleSheet>"
    path = tmp_path / "formats.xlsx"
    with zipfile.ZipFile(made) as old, zipfile.ZipFile(path, "w") as new:
        for name in old.namelist():
            data = old.read(name).decode()
            if name.endswith("sheet1.xml"):
                for k, cell in enumerate(["A2", "B2", "C2", "D2", "E2"]):
                    data = re.sub(f'<c r="{cell}"', f'<c r="{cell}" s="{k}"', data)
                data = data.replace('<c r="F2"', '<c r="F2" s="1"')
            if name != "xl/styles.xml":
                new.writestr(name, data)
        new.writestr("xl/styles.xml", styles)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abcde"] + [T.StructField("f", T.DoubleType())])
    assert [tuple(r) for r in read_xlsx(spark, str(path), schema).collect()] == [("7", "2024-01-31", "25.6%", "1,234.50", "00042", 45322.0)]
