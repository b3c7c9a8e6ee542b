"""Column expressions (projections): pure built-ins, no Python in the row path."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Eligibility reason codes in report order.
ELIGIBILITY_REASONS = (
    "NOT_IN_PRIMARY_MATRIX",
    "UPSTREAM_OFF_TISSUE",
    "ZERO_TOTAL_COUNTS",
    "ZERO_DETECTED_GENES",
    "OUTSIDE_MANUAL_ROI",
    "ROI_LABEL_EXCLUDED",
    "TISSUE_SOURCE_CONFLICT",
    "ROI_LABEL_MISSING",
    "ROI_UNAVAILABLE",
    "COORDINATE_OUT_OF_IMAGE_BOUNDS",
    "ELIGIBILITY_SOURCE_UNAVAILABLE",
)
# Reasons that decide each state, strongest state first.
STATE_REASONS = {
    "exclude": (
        "NOT_IN_PRIMARY_MATRIX",
        "UPSTREAM_OFF_TISSUE",
        "ZERO_TOTAL_COUNTS",
        "ZERO_DETECTED_GENES",
        "OUTSIDE_MANUAL_ROI",
        "ROI_LABEL_EXCLUDED",
    ),
    "not_evaluable": ("ROI_UNAVAILABLE", "ELIGIBILITY_SOURCE_UNAVAILABLE"),
    "review": ("ROI_LABEL_MISSING", "COORDINATE_OUT_OF_IMAGE_BOUNDS"),
}
ELIGIBILITY_STATES = ("keep", "exclude", "review", "not_evaluable")


def mitochondrial(symbol: Column, prefixes: Iterable[str] = ("MT-",),
                  case_sensitive: bool = False) -> Column:
    """The symbol starts with any prefix."""
    value = symbol if case_sensitive else F.upper(symbol)
    hit = F.lit(False)
    for prefix in prefixes:
        hit = hit | value.startswith(prefix if case_sensitive else prefix.upper())
    return F.coalesce(hit, F.lit(False))


def barcode_core_loose(barcode: Column) -> Column:
    """Upper-cased barcode without ``-digits`` when it looks like a 10x barcode."""
    upper = F.upper(F.trim(barcode))
    return F.when(upper.rlike("^[ACGTN]+-[0-9]+$"), F.regexp_extract(upper, "^([ACGTN]+)-", 1))


def barcode_core_strict(barcode: Column) -> Column:
    """The 16-mer of ``16-mer-positive integer``, else NULL."""
    return F.nullif(F.regexp_extract(barcode, "^([ACGTN]{16})-[1-9][0-9]*$", 1), F.lit(""))


def blank_to_null(text: Column) -> Column:
    return F.when(F.trim(text) != "", text)


def label_excluded(label: Column, excluded: Iterable[str], case_sensitive: bool = False) -> Column:
    names = [x.strip() if case_sensitive else x.strip().lower() for x in excluded]
    value = label if case_sensitive else F.lower(F.trim(label))
    return value.isin(*names) if names else F.lit(False)


def roi_usable(source: Column, canonical: Column, excluded: Iterable[str]) -> Column:
    """Neither label is missing or excluded (case-folded)."""
    names = list(excluded)
    bad = label_excluded(source, names) | label_excluded(canonical, names)
    return ~F.coalesce(bad, F.lit(True))


def reason_text(flags: Iterable[tuple[str, Column]]) -> Column:
    """Codes whose flag holds, in the given order, joined by ``;``."""
    return F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags])), ";")


def eligibility_flags(has_roi: bool, bounds_action: str = "review") -> list[tuple[str, Column]]:
    """One flag per reason over the joined decision table."""
    no = F.lit(False)
    primary = F.col("in_primary_matrix")
    tissue = F.col("in_tissue")
    member = F.coalesce(F.col("roi_member"), no)
    missing = member & blank_to_null(F.col("roi_label")).isNull()
    excluded = member & ~missing & F.coalesce(F.col("roi_label_excluded"), no)
    # What the manual region says: unknown without a label, else member and not excluded.
    manual = F.when(~missing, member & ~excluded)
    conflict = F.coalesce((tissue == 1) != manual, no) & (primary | member)
    flags = {
        "NOT_IN_PRIMARY_MATRIX": ~primary,
        "UPSTREAM_OFF_TISSUE": F.coalesce(tissue == 0, no),
        "ZERO_TOTAL_COUNTS": primary & (F.col("total_counts") == 0),
        "ZERO_DETECTED_GENES": primary & (F.col("n_genes_by_counts") == 0),
        "OUTSIDE_MANUAL_ROI": primary & ~member if has_roi else no,
        "ROI_LABEL_EXCLUDED": excluded if has_roi else no,
        "TISSUE_SOURCE_CONFLICT": conflict if has_roi else no,
        "ROI_LABEL_MISSING": missing if has_roi else no,
        "ROI_UNAVAILABLE": no if has_roi else primary,
        "COORDINATE_OUT_OF_IMAGE_BOUNDS": (F.col("bounds_status") == "outside")
        if bounds_action == "review" else no,
        "ELIGIBILITY_SOURCE_UNAVAILABLE": primary & tissue.isNull(),
    }
    return [(code, flags[code]) for code in ELIGIBILITY_REASONS]


def state_from_reasons(reasons: Column) -> Column:
    """Exclude > not_evaluable > review > keep over a ``;`` list."""
    codes = F.split(reasons, ";")

    def any_of(names):
        return F.arrays_overlap(codes, F.array(*[F.lit(n) for n in names]))

    state = F.lit("keep")
    for name, names in reversed(STATE_REASONS.items()):
        state = F.when(any_of(names), name).otherwise(state)
    return state


def recommended_keep(state: Column) -> Column:
    """Keep -> true, exclude -> false, anything else undetermined."""
    return F.when(state == "keep", True).when(state == "exclude", False)


def bounds_status(x: Column, y: Column, scale: Column, width: Column, height: Column) -> Column:
    """Scaled pixel centre against [0,w) x [0,h)."""
    sx, sy = x * scale, y * scale
    return (
        F.when(sx.isNull() | sy.isNull() | width.isNull() | height.isNull(), "not_available")
        .when((sx < 0) | (sx >= width) | (sy < 0) | (sy >= height), "outside")
        .otherwise("inside")
    )


def gate_reasons(source_reasons: Column, recommended: Column, total: Column, genes: Column,
                 min_genes: int) -> Column:
    """P10: analysis gate codes appended to the source codes without repeats."""
    gate = F.array_compact(F.array(
        F.when(~F.coalesce(recommended, F.lit(False)), F.lit("UPSTREAM_NOT_RECOMMENDED")),
        F.when(total == 0, F.lit("ZERO_TOTAL_COUNTS")),
        F.when((genes < min_genes) & (total != 0), F.lit("BELOW_MIN_GENES")),
    ))
    source = F.filter(F.split(F.coalesce(source_reasons, F.lit("")), ";"), lambda c: c != "")
    return F.array_distinct(F.concat(source, gate))


def gene_filter_reason(n_spots: Column, min_spots: int) -> Column:
    """P11."""
    return F.when(n_spots >= min_spots, "KEEP").otherwise("BELOW_MIN_SPOTS")


def log1p_cp(count: Column, total: Column, target: float = 1e4) -> Column:
    """ln(1 + count * target / total)."""
    return F.log1p(count * F.lit(float(target)) / total)


def log2_cpm1(count: Column, library: Column) -> Column:
    """log2(CPM + 1)."""
    return F.log2(count / library * F.lit(1e6) + 1)


def threshold_class(value: Column, warn: Column, passed: Column, higher_is_better: Column) -> Column:
    """PASS / WARN / FAIL; UNCALIBRATED without limits; NA without a value."""
    return (
        F.when(value.isNull(), "NA")
        .when(warn.isNull() & passed.isNull(), "UNCALIBRATED")
        .when(higher_is_better,
              F.when(value < warn, "FAIL").when(value < passed, "WARN").otherwise("PASS"))
        .otherwise(F.when(value <= passed, "PASS").when(value <= warn, "WARN").otherwise("FAIL"))
    )


def barcode_from_observation(observation: Column, sample: Column) -> Column:
    """The barcode in ``sample::barcode``; NULL when the prefix differs."""
    prefix = F.concat(sample, F.lit("::"))
    return F.when(observation.startswith(prefix),
                  F.substring(observation, F.length(prefix) + 1, F.length(observation)))


def barcode_without_sample_suffix(identifier: Column, sample: Column) -> Column:
    """The barcode in ``barcode-sample``; NULL when the suffix differs or nothing is left."""
    ident, name = F.trim(identifier), F.trim(sample)
    suffix = F.concat(F.lit("-"), name)
    keep = F.length(ident) - F.length(suffix)
    return F.when((name != "") & ident.endswith(suffix) & (keep > 0),
                  F.substring(ident, F.lit(1), keep))


def design_cell(genotype: Column, treatment: Column, g_ref: str, g_alt: str, t_ref: str,
                t_alt: str) -> Column:
    """g0_t0 .. g1_t1; NULL outside the configured 2x2."""
    g = F.when(genotype == g_ref, "g0").when(genotype == g_alt, "g1")
    t = F.when(treatment == t_ref, "t0").when(treatment == t_alt, "t1")
    return F.when(g.isNotNull() & t.isNotNull(), F.concat(g, F.lit("_"), t))


def stable_seed(*parts: Column) -> Column:
    """SHA-256 of NUL-joined text, first eight bytes big-endian, modulo 2^32."""
    digest = F.sha2(F.concat_ws("\0", *[p.cast("string") for p in parts]), 256)
    return F.conv(F.substring(digest, 9, 8), 16, 10).cast("long")


def fingerprint(payload: Column) -> Column:
    """SHA-256 of the JSON text of a struct (fields in name order)."""
    return F.sha2(F.to_json(payload), 256)


# What counts as a local path inside free text.
LOCAL_PATH_TEXT = (
    r"(?i)\bfile://[^\s<>\"']+",
    r"(?<![A-Za-z0-9])(?:[A-Za-z]:[\\/]|\\\\)[^\s<>\"';,)\]}]+",
    r"(?<![A-Za-z0-9:<>'\"/])~[/\\][^\s<>\"';,)\]}]+",
    r"(?U)(?<![A-Za-z0-9:<>'\"/>])/(?=[\w.~\-])[^\s<>\"';,)\]}]+",
)


def redact_paths(text: Column) -> Column:
    """P19."""
    for pattern in LOCAL_PATH_TEXT:
        text = F.regexp_replace(text, pattern, "<redacted-path>")
    return text


def portable_path(path: Column, root: str) -> Column:
    """P20: project-relative, or ``<external>/name``."""
    base = root.rstrip("/") + "/"
    return (
        F.when(path.startswith(base), F.substring(path, F.lit(len(base) + 1), F.length(path)))
        .when(path.startswith("/"), F.concat(F.lit("<external>/"), F.regexp_extract(path, "([^/]+)$", 1)))
        .otherwise(path)
    )


def step_id(path: Column) -> Column:
    """File name without its known suffix; generic names get their parent."""
    name = F.regexp_extract(path, "([^/]+)$", 1)
    parent = F.regexp_extract(path, "([^/]+)/[^/]+$", 1)
    stem = F.regexp_replace(
        name, r"(\.summary\.json|\.resources\.json|_summary\.json|\.json)$", "")
    generic = stem.isin("resource", "resources", "summary")
    return F.when(generic, F.concat(parent, F.lit("_"), stem)).otherwise(stem)


def natural_key(text: Column) -> Column:
    """Sort key in which runs of digits of any length compare as numbers.

    A run without leading zeros is preceded by its length, so a longer one is larger; "0" before
    it keeps digits before letters.
    """
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\d+|\D+)"), 1)
    def number(r: Column) -> Column:
        digits = F.regexp_replace(r, r"^0+(?=\d)", "")
        return F.concat(F.lit("0"), F.lpad(F.length(digits).cast("string"), 10, "0"), digits)

    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"^\d"), number(r)).otherwise(r)), "")


def sample_from_path(path: Column) -> Column:
    """The component after qc, input or svg, unless it is a shared folder or a file."""
    found = []
    for anchor in ("qc", "input", "svg"):
        part = F.regexp_extract(path, f"(?:^|/){anchor}/([^/]+)", 1)
        usable = (part != "") & ~part.isin("cohort", "report") & ~part.contains(".")
        found.append(F.when(usable, part))
    return F.coalesce(*found)


def safe_ratio(x: Column, y: Column) -> Column:
    """P24."""
    return x / F.nullif(y, F.lit(0))


def difference_class(current: Column, reference: Column) -> Column:
    """P25."""
    gap = F.abs(current - reference)
    return (
        F.when(current.isNull() | reference.isNull(), "metric_missing_on_one_side")
        .when(gap <= 1e-9, "exact")
        .when(gap <= 1e-3, "rounding_only")
        .otherwise("expected_population_or_method_difference")
    )


def resolution_token(resolution: Column) -> Column:
    """Six significant digits, "." as p and "-" as m: 0.6 -> 0p6, -0.5 -> m0p5, 1e-7 -> 1em07."""
    x = resolution.cast("double")
    science = F.format_string("%.5e", x)
    power = F.regexp_extract(science, r"e([+-]\d+)$", 1).cast("int")
    digits = F.regexp_replace(F.regexp_extract(science, r"^([^e]*)e", 1), r"\.?0+$", "")
    scientific = F.concat(digits, F.lit("e"), F.regexp_extract(science, r"e([+-]\d+)$", 1))
    plain = F.lit(None).cast("string")
    for p in range(-4, 6):
        fixed = F.format_string(f"%.{5 - p}f", x)
        plain = F.when(power == p, F.regexp_replace(fixed, r"\.0*$|(\.\d*?)0+$", "$1") if p < 5 else fixed).otherwise(plain)
    text = F.when(x == 0, "0").when(power.between(-4, 5), plain).otherwise(scientific)
    return F.translate(text, ".-", "pm")


def glob_to_regex(glob: str) -> str:
    """Glob pattern, with ``[...]`` and ``[!...]`` classes, as a full-match regular expression."""
    out, i = [], 0
    while i < len(glob):
        ch = glob[i]
        # A class may start with its own closing bracket; without an end, "[" is itself.
        start = i + 1 + (glob[i + 1:i + 2] == "!")
        end = glob.find("]", start + 1) if ch == "[" else -1
        if end > 0:
            body = re.sub(r"([\\\[\]^&~|])", r"\\\1", glob[start:end])
            out.append(f"[{'^' if start == i + 2 else ''}{body}]")
            i = end
        else:
            out.append(".*" if ch == "*" else "." if ch == "?" else re.escape(ch))
        i += 1
    return "^" + "".join(out) + "$"


def parse_boolean(text: Column, extra_true: Iterable[str] = (), extra_false: Iterable[str] = ()
                  ) -> Column:
    """true/1 and false/0, trimmed and case-folded; anything else NULL."""
    value = F.lower(F.trim(text))
    return F.when(value.isin("true", "1", *extra_true), True).when(
        value.isin("false", "0", *extra_false), False)
