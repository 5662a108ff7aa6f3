"""Displayed text of numeric spreadsheet cells.

A workbook stores a number and a format code; string columns take what a sheet
shows.  ``formatter(code)`` compiles a code once per workbook and style into a
function of the stored text:

sections   ``positive;negative;zero``, a section's own condition ``[<100]`` aside
digits     ``0 # ?``, decimals, thousands ``,`` between digits, scaling ``,`` after
           them, ``%``, ``E+00``; rounding is half up
dates      ``y m d h s``, ``AM/PM``, ``[h] [m] [s]`` elapsed, fractions of seconds;
           ``m`` is minutes next to hours or seconds and months elsewhere
literals   ``"text"``, ``\\x``, currency ``[$€-407]``; colours and locales are left out,
           ``_x`` is a space and ``*x`` nothing

``General``, text formats (``@``), fractions, conditions and codes that cannot be
read give the number in plain notation, and so does a date outside the calendar.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Context, Decimal, InvalidOperation

_FIFTEEN_DIGITS = Context(prec=15)
_WIDE = Context(prec=60, rounding=ROUND_HALF_UP)
_EPOCH = _dt.datetime(1899, 12, 30)

# FIXED VALUES — the number formats that a workbook names by id without a code
# of its own (the file format's built-in list, in its order).
BUILT_IN = {
    0: "General", 1: "0", 2: "0.00", 3: "#,##0", 4: "#,##0.00", 9: "0%", 10: "0.00%", 11: "0.00E+00", 12: "# ?/?", 13: "# ??/??",
    14: "m/d/yy", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm AM/PM", 19: "h:mm:ss AM/PM", 20: "h:mm", 21: "h:mm:ss", 22: "m/d/yy h:mm",
    37: "#,##0 ;(#,##0)", 38: "#,##0 ;[Red](#,##0)", 39: "#,##0.00;(#,##0.00)", 40: "#,##0.00;[Red](#,##0.00)",
    45: "mm:ss", 46: "[h]:mm:ss", 47: "mm:ss.0", 48: "##0.0E+0", 49: "@",
}

_TOKEN = re.compile(
    r'"(?P<text>[^"]*)"|\\(?P<escaped>.)|_(?P<space>.)|\*.|\[\$(?P<currency>[^\]-]*)(?:-[^\]]*)?\]|\[(?P<elapsed>h+|m+|s+)\]|\[(?P<other>[^\]]*)\]'
    r"|(?P<ampm>AM/PM|A/P)|(?P<date>y+|m+|d+|h+|s+)|(?P<exponent>E[+-]0+)|(?P<digits>[0#?.,]+)|(?P<percent>%)|(?P<fraction>/)|(?P<at>@)|(?P<plain>.)",
    re.IGNORECASE | re.DOTALL,
)


def plain_number(text: str) -> str:
    """A stored number in plain notation: 15 significant digits, as a sheet
    shows (17 are stored), no exponent; anything else as it is."""

    d = _decimal(text)
    if d is None:
        return text
    return str(int(d)) if d == d.to_integral_value() else format(d.normalize(), "f")


def _decimal(text: str) -> Decimal | None:
    try:
        d = _FIFTEEN_DIGITS.create_decimal(text)
    except InvalidOperation:
        return None
    return d if d.is_finite() else None


class _Unreadable(ValueError):
    """A code beyond what is rendered here."""


def _tokens(section: str) -> list[tuple[str, str]]:
    out = []
    for m in _TOKEN.finditer(section):
        kind, value = m.lastgroup, m[m.lastgroup] if m.lastgroup else ""
        if kind == "other":
            if re.search("[<>=]", value):
                raise _Unreadable(section)
        elif kind in ("text", "escaped", "currency", "plain"):
            out.append(("text", value))
        elif kind == "space":
            out.append(("text", " "))
        elif kind in ("fraction", "at"):
            out.append((kind, m[0]))
        elif kind:
            out.append((kind, value))
    return out


def _sections(code: str) -> list[str]:
    parts, now = [], ""
    for m in re.finditer(r'"[^"]*"|\\.|_.|\*.|\[[^\]]*\]|;|.', code, re.DOTALL):
        if m[0] == ";":
            parts.append(now)
            now = ""
        else:
            now += m[0]
    return [*parts, now]


# --- dates -------------------------------------------------------------------


def _date(tokens: list[tuple[str, str]]) -> Callable[[Decimal], str]:
    # a slash is a separator here, and digits are fractions of seconds
    kinds = [("text", v) if k == "fraction" or re.fullmatch("[.,]", v) else (k, v.lower() if k in ("date", "elapsed") else v) for k, v in tokens]
    units = [(i, v[0]) for i, (k, v) in enumerate(kinds) if k in ("date", "elapsed")]
    minutes = set()
    for n, (i, unit) in enumerate(units):
        before, after = units[n - 1][1] if n else "", units[n + 1][1] if n + 1 < len(units) else ""
        if unit == "m" and len(kinds[i][1]) <= 2 and (before == "h" or after == "s" or kinds[i][0] == "elapsed"):
            minutes.add(i)
    half = any(k == "ampm" for k, _ in kinds)
    places = max((len(v) - v.find(".") - 1 for k, v in kinds if k == "digits" and v.startswith(".")), default=0)

    def show(d: Decimal) -> str:
        steps = 10**places
        total = int((d * 86400 * steps).to_integral_value(ROUND_HALF_UP))
        seconds, parts = divmod(total, steps)
        try:
            t = _EPOCH + _dt.timedelta(seconds=seconds)
        except OverflowError:
            raise _Unreadable from None
        out = []
        for i, (k, v) in enumerate(kinds):
            n = len(v)
            if k == "text":
                out.append(v)
            elif k == "ampm":
                mark = "AM" if t.hour < 12 else "PM"
                out.append(mark if len(v) > 3 else mark[0])
            elif k == "digits" and v.startswith("."):
                out.append(f".{parts:0{places}d}")
            elif k == "elapsed":
                out.append(f"{seconds // {'h': 3600, 'm': 60, 's': 1}[v[0]]:0{n}d}")
            elif k != "date":
                raise _Unreadable
            elif v[0] == "y":
                out.append(f"{t.year:04d}" if n > 2 else f"{t.year % 100:02d}")
            elif v[0] == "m" and i not in minutes:
                name = t.strftime("%B")
                out.append(f"{t.month:0{n}d}" if n <= 2 else {3: name[:3], 5: name[0]}.get(n, name))
            elif v[0] == "d":
                name = t.strftime("%A")
                out.append(f"{t.day:0{n}d}" if n <= 2 else name[:3] if n == 3 else name)
            else:
                value = {"h": (t.hour % 12 or 12) if half else t.hour, "m": t.minute, "s": t.second}[v[0]]
                out.append(f"{value:0{min(n, 2)}d}")
        return "".join(out)

    return show


# --- numbers -----------------------------------------------------------------


def _number(tokens: list[tuple[str, str]]) -> Callable[[Decimal], str]:
    if any(k in ("fraction", "at", "ampm") for k, _ in tokens):
        raise _Unreadable
    places = [i for i, (k, _) in enumerate(tokens) if k == "digits"]
    text = lambda i, j: "".join("%" if k == "percent" else v for k, v in tokens[i:j] if k in ("text", "percent"))
    if not places:
        whole = text(0, len(tokens))
        return lambda d: whole
    head, pattern, tail = text(0, places[0]), "".join(v for k, v in tokens[places[0] : places[-1] + 1] if k == "digits"), ""
    exponent = next((v for k, v in tokens if k == "exponent"), None)
    inner = [v for k, v in tokens[places[0] : places[-1] + 1] if k in ("text", "percent")]
    if any(inner) and exponent is None:
        return _spread(tokens, places, head, text(places[-1] + 1, len(tokens)))
    tail = text(places[-1] + 1, len(tokens))
    scale = len(pattern) - len(pattern.rstrip(","))
    pattern = pattern.rstrip(",")
    whole, _, decimals = pattern.partition(".")
    if "." in decimals or "," in decimals:
        raise _Unreadable
    grouped, whole = "," in whole, whole.replace(",", "")
    least = len(whole) - len(whole.lstrip("#")) if whole else 0
    least = len(whole) - least
    percent = 2 * sum(k == "percent" for k, _ in tokens)
    always = len(decimals.rstrip("#?"))

    def shown(d: Decimal) -> str:
        q = _WIDE.quantize(d, Decimal(1).scaleb(-len(decimals)))
        left, _, right = format(q, "f").partition(".")
        left = left.lstrip("0").rjust(least, "0")
        if grouped:
            left = re.sub(r"(?<=\d)(?=(\d{3})+$)", ",", left)
        while len(right) > always and right.endswith("0"):
            right = right[:-1]
        return left + ("." + right if right or decimals else "")

    def show(d: Decimal) -> str:
        if exponent is None:
            return head + shown(abs(d).scaleb(percent - 3 * scale)) + tail
        size, step = abs(d), max(1, len(whole))
        power = size.adjusted() if size else 0
        power -= power % step if step > 1 else 0
        mantissa = shown(size.scaleb(-power))
        if step == 1 and mantissa.startswith("10"):  # rounding up gave one digit more
            power += 1
            mantissa = shown(size.scaleb(-power))
        sign = "-" if power < 0 else "+" if exponent[1] == "+" else ""
        return f"{head}{mantissa}E{sign}{abs(power):0{len(exponent) - 2}d}{tail}"

    return show


def _spread(tokens: list[tuple[str, str]], places: list[int], head: str, tail: str) -> Callable[[Decimal], str]:
    """A whole number dealt to digit groups with text between (``000-00-0000``)."""

    middle = tokens[places[0] : places[-1] + 1]
    if any(k == "digits" and re.search("[.,]", v) or k == "percent" for k, v in middle):
        raise _Unreadable
    wide = sum(len(v) for k, v in middle if k == "digits")

    def show(d: Decimal) -> str:
        digits = str(int(abs(d).to_integral_value(ROUND_HALF_UP))).rjust(wide, "0")
        out, at = [], len(digits)
        for n, (k, v) in enumerate(reversed(middle)):
            if k == "text":
                out.append(v)
            else:
                begin = 0 if n == len(middle) - 1 else at - len(v)
                out.append(digits[begin:at])
                at = begin
        return head + "".join(reversed(out)) + tail

    return show


def formatter(code: str | None) -> Callable[[str], str]:
    """The function that shows a stored number in the format ``code``."""

    if not code or code.strip().lower() in ("general", "@"):
        return plain_number
    try:
        parts = []
        for section in _sections(code)[:3]:
            tokens = _tokens(section)
            if any(k == "text" and v.lower() == "general" for k, v in tokens) or re.fullmatch("(?i)general", section.strip()):
                parts.append(None)
                continue
            parts.append((_date if any(k in ("date", "elapsed") for k, _ in tokens) else _number)(tokens))
    except _Unreadable:
        return plain_number
    dated = any(k in ("date", "elapsed") for k, _ in _tokens(_sections(code)[0]))

    def show(text: str) -> str:
        d = _decimal(text)
        if d is None:
            return text
        if dated and d < 0:
            return plain_number(text)
        which = 1 if d < 0 and len(parts) > 1 else 2 if d == 0 and len(parts) > 2 else 0
        part = parts[which]
        if part is None:
            return plain_number(text)
        try:
            shown = part(d)
        except (_Unreadable, InvalidOperation, OverflowError):
            return plain_number(text)
        # only the first section leaves the sign to us, and a number that rounds to zero has none
        return "-" + shown if d < 0 and which == 0 and re.search("[1-9]", shown) else shown

    return show
