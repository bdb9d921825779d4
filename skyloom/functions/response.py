"""The response model: terms as design columns, evaluated with global or per-image coefficients.

The model adds to the magnitude: ``Z`` the zeropoint; ``P...`` monomials over A (airmass) B (airmass less the image's)
C D E F (colours) R (x^2 + y^2) X Y (image coordinates) N (magnitude + 10), a digit after a letter is its power
(``P2XY``: the power stands before its letter); ``SX SY SXY`` sub-pixel waves; ``XC`` and ``SC`` colour terms; ``RS RO
RC`` a rational function of the magnitude; ``GA GW`` and ``EA EW`` radial functions. ``term:n`` holds for image n only.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns behind the letters of a monomial.
LETTERS = {"A": "airmass_abs", "B": "adif", "C": "color1", "D": "color2", "E": "color3", "F": "color4", "X": "coord_x", "Y": "coord_y"}
NONLINEAR = ("XC", "SC", "RS", "RO", "RC", "GA", "GW", "EA", "EW")
_IMAGE = re.compile(r"^(.*):(\d+)$")


def split_term(term: str) -> tuple[str, int | None]:
    """('PX', 3) of ``PX:3``; (term, None) of a global term."""
    m = _IMAGE.match(term)
    return (m[1], int(m[2])) if m else (term, None)


def _number(df: DataFrame, name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)


def factor(df: DataFrame, term: str, mag: str = "mag_auto") -> Column:
    """Design column of a linear term, without its image suffix."""
    if term == "Z":
        return F.lit(1.0)
    wave = lambda c: F.sin(math.pi * (_number(df, c) - F.floor(_number(df, c))))
    if term == "SX":
        return wave("cat_x")
    if term == "SY":
        return wave("cat_y")
    if term == "SXY":
        return wave("cat_x") * wave("cat_y")
    if not re.fullmatch(r"P(\d?[ABCDEFNRXY])+", term):
        raise ValueError(f"unknown term {term}")
    out = F.lit(1.0)
    for power, letter in re.findall(r"(\d?)([A-Z])", term[1:]):
        if letter == "R":
            base = _number(df, "coord_x") * _number(df, "coord_x") + _number(df, "coord_y") * _number(df, "coord_y")
        elif letter == "N":
            base = F.col(mag) + 10
        else:
            base = _number(df, LETTERS[letter])
        for _ in range(int(power or 1)):
            out = out * base
    return out


def term_columns(terms: list[str]) -> set[str]:
    """Names of the columns that terms read, apart from the magnitude."""
    out: set[str] = set()
    for term in terms:
        base, n = split_term(term)
        out |= {"image_id"} if n is not None else set()
        if base in ("SX", "SY", "SXY"):
            out |= {"cat_x", "cat_y"}
        elif base in ("XC", "SC"):
            out |= {"color1", "color2", "color3"}
        elif base in NONLINEAR or "R" in base:
            out |= {"coord_x", "coord_y"}
        out |= {LETTERS[letter] for letter in base[1:] if letter in LETTERS and base not in NONLINEAR}
    return out


def is_linear(term: str) -> bool:
    return split_term(term)[0] not in NONLINEAR


def color_value(df: DataFrame, term: str, value: Column) -> Column:
    """XC (piecewise linear) or SC (smooth) colour term of a coefficient; the reference band is schema[1]."""
    c1, c2, c3 = (_number(df, f"color{i}") for i in (1, 2, 3))
    far = (value - 1) * c3 + c2
    if term == "XC":
        return F.when(value < 0, value * c1).when(value <= 1, value * c2).otherwise(far)
    s = F.sin(value * math.pi)
    w1, w2 = 0.5 * (1 - s), 0.5 * (1 + s)
    near, middle = w1 * value * c1 + w2 * value * c2, c2 + w2 * (value - 1) * c2 + w1 * (value - 1) * c3
    return F.when(value < -0.5, value * c1).when(value < 0.5, near).when(value <= 1.5, middle).otherwise(far)


def eval_response(df: DataFrame, model: dict[str, float] | str, mag: str = "mag_auto", image: str = "image_id", out: str = "mag_model", skip: tuple[str, ...] = ()) -> DataFrame:
    """Adds the modelled magnitude. ``model`` is a dict of coefficients or the name of a map column of the row
    (term -> value, as ``response_terms`` makes of a RESPONSE string); terms in ``skip`` count 0."""
    if isinstance(model, dict):
        terms = {t: F.lit(float(v)) for t, v in model.items() if split_term(t)[0] not in skip}
    else:
        # A stored response has its own image's terms only; the union of names must be fixed to make one expression.
        names = ["Z", "SX", "SY", "SXY", *NONLINEAR, *monomials(3, "XY"), *monomials(2, "R"), "PC", "PD", "PE", "PF", "PB", "PA", "P2C", "PCD", "PN", "PBC"]
        terms = {t: F.coalesce(F.try_element_at(F.col(model), F.lit(t)), F.lit(0.0)) for t in dict.fromkeys(names) if t not in skip}
    total, own = F.col(mag), {}
    for term, value in terms.items():
        base, n = split_term(term)
        if base in NONLINEAR and base not in ("XC", "SC"):
            own[base] = value
            continue
        part = color_value(df, base, value) if base in ("XC", "SC") else value * factor(df, base, mag)
        total = total + (F.when(F.col(image) == n, part).otherwise(F.lit(0.0)) if n is not None else part)
    radius2 = _number(df, "coord_x") * _number(df, "coord_x") + _number(df, "coord_y") * _number(df, "coord_y")
    if "GA" in own and "GW" in own:
        total = total + own["GA"] * F.exp(-radius2 * 25 / F.pow(F.lit(10.0), own["GW"]))
    if "EA" in own and "EW" in own:
        q = F.sqrt(F.coalesce(F.try_divide(radius2, own["EW"]), F.lit(0.0)))
        total = total + own["EA"] * (F.exp(q) / (q + 1) - 1)
    if "RS" in own:
        x = -(F.col(mag) + 10) - own.get("RO", F.lit(0.0))
        total = total + own["RS"] * x / (1 + own.get("RC", F.lit(0.0)) * x * x + 1e-10)
    return df.withColumn(out, total)


def monomials(order: int, letters: str) -> list[str]:
    """Names of the monomials up to a total power, such as PX, PY, P2X, PXY, P2Y."""
    names: list[str] = []
    power = lambda k, c: (f"{k}" if k > 1 else "") + c if k else ""
    if len(letters) == 1:
        return ["P" + power(k, letters) for k in range(1, order + 1)]
    for total in range(1, order + 1):
        for k in range(total, -1, -1):
            names.append("P" + power(k, letters[0]) + power(total - k, letters[1]))
    return names


def response_terms(text: Column) -> Column:
    """Map term -> value of a RESPONSE string ``FILTER=..,SCHEMA=..,Z=..,PX=..`` (numbers only).

    Names of filters and schemas are not tried as numbers: each such cast would throw in Java, which costs more than the
    rest. Of letters only I (Infinity) and N (NaN) can begin a number."""
    pairs = F.str_to_map(text, F.lit(","), F.lit("="))
    number = lambda v: F.when(~v.rlike(r"^\s*[A-HJ-MO-Za-hj-mo-z_]"), v.try_cast("double"))
    return F.map_filter(F.transform_values(pairs, lambda _, v: number(v)), lambda _, v: v.isNotNull())


def parse_terms(text: str, stepwise: bool = False) -> dict[str, list[str]]:
    """Term list as groups. Names are comma-separated; ``.pN`` is all monomials in X and Y up to N, ``.rN`` powers
    of R whose degree in X and Y is above that of ``.p``, ``.cN .dN .eN .fN .nN`` powers of a colour or the magnitude,
    ``.s`` SX SY SXY, ``.l`` XC. A prefix says what becomes of a term: ``@`` stepwise, ``&`` always, ``#`` fixed
    (``#PX=0.1``), ``*`` one per image; without one it is stepwise or always as ``stepwise`` says. Of a term's groups
    fixed counts before per-image, always and stepwise."""
    groups: dict[str, list[str]] = {"fixed": [], "per_image": [], "always": [], "stepwise": []}
    names = {"@": "stepwise", "&": "always", "#": "fixed", "*": "per_image"}
    degree = max([int(n) for n in re.findall(r"\.p(\d)", text)], default=0)
    for item in filter(None, (x.strip() for x in text.split(","))):
        group = names.get(item[0], "stepwise" if stepwise else "always")
        item = item[1:] if item[0] in names else item
        macro = re.fullmatch(r"\.([prcdefnsl])(\d?)", item)
        if macro:
            kind, n = macro[1], int(macro[2] or 1)
            expand = {
                "p": lambda: monomials(n, "XY"),
                "r": lambda: [t for k, t in enumerate(monomials(n, "R"), 1) if 2 * k > degree],
                "s": lambda: ["SX", "SY", "SXY"],
                "l": lambda: ["XC"],
            }.get(kind, lambda: monomials(n, kind.upper()))
            groups[group] += expand()
        else:
            groups[group].append(item)
    seen: set[str] = set()
    for group in groups:
        groups[group] = [t for t in dict.fromkeys(groups[group]) if t.split("=")[0] not in seen]
        seen |= {t.split("=")[0] for t in groups[group]}
    return groups
