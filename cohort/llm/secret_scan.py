"""Secret scans in DataFrame functions: fixed patterns and sliding-window entropy.

Fixed kinds, each leftmost and non-overlapping: ``assign`` (a credential name, a separator,
a value of 6+ characters), ``access`` (AKIA keys of 20+ characters), ``hex`` (24+ lower-case hex
digits). A short ``assign`` match is dropped only after matching, so what it covers stays
consumed. For the other two, asking for the length inside the pattern finds the same spans,
as a maximal run that is too short holds no longer run.

The method's kind, ``entropy``: candidate strings are maximal runs of 20+ characters of
[A-Za-z0-9+/_=-]. A window of ``WINDOW`` characters slides over a candidate; its
character counts are updated by the character that enters and the one that leaves, and with
them sum(c log2 c), which gives the Shannon entropy. A window counts if it reaches the threshold of its
candidate's character class (hex, one letter case with digits, mixed). The span runs
from the first such window to the last. Allow-listed candidates (no digit or no letter, UUIDs,
marked examples) and candidates that touch a fixed span are dropped.

``parts``, of the same kind, holds what these drops leave: candidates are cut at fixed spans, at UUIDs
and at marked parts (letters and digits between separators), and what is left of 20+ characters is
scanned like a candidate of its own. A marked part hides only itself, a fixed span only what it covers.
Here a window of digits and letters only, with both, is judged by the class of its own characters, so a
name or path joined to a hex value does not raise what the value's windows must reach; windows with a
separator, mostly words and paths, stay with the class of what is scanned.

Everything runs as expressions on one narrow projection: no Python, no shuffle. Cheap
tests of the whole text go first, and only texts that pass are cut up.

Defined results: null and empty texts have no spans; repeated rows each give a row; offsets are code points.
Very long texts with very many spans take time in proportion: spans are merged by a running maximum and texts rebuilt
from blocks, never from their beginning; only sorting the spans adds a logarithm.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort.llm.common import pick
from cohort.llm.native import between, blocks, let, matches, running

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
# A candidate in a text whose fixed spans are filled, none of it cut off by a fill.
FILL = "\x01"
UNTOUCHED = r"(?<![A-Za-z0-9+/_=\x01-])[A-Za-z0-9+/_=-]{20,}+(?!\x01)"
KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
# Bits a window must reach, by class of its candidate. A random window of 20 has about 3.4 bits in
# hex and 4.0 or more in the wider alphabets; words of prose with digits stay below.
THRESHOLDS = {"hex": 3.0, "plain": 3.6, "mixed": 3.8}
ALLOWED = (r"^[^0-9]*$|^[^A-Za-z]*$"
           r"|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
           r"|(?i:example|placeholder|changeme|dummy|xxxx)")
# What the allow-list hides of a longer candidate: the marked part, or the UUID, alone.
HIDDEN = (r"(?<![A-Za-z0-9])(?:[A-Za-z0-9]*?(?i:example|placeholder|changeme|dummy|xxxx)[A-Za-z0-9]*"
          r"|[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![A-Za-z0-9]))")

# Character groups that tell the class of a window; None takes what is left.
_GROUPS = {"digit": "09", "low_hex": "af", "low": "gz", "up_hex": "AF", "up": "GZ", "other": None}


def _c_log_c(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(c.cast("double"))).otherwise(0.0)


def strong_windows(candidate: Column, threshold: Column, window: int = WINDOW,
                   own: dict[str, float] | None = None) -> Column:
    """First and last end (1-based) of the windows at or above ``threshold``; 0 if none.

    With ``own``, windows of digits and letters, with both, must reach the threshold of their own class.
    State: counts by character code, sum(c log2 c), first, last, with ``own`` also where each
    character group was last seen. Each step adds the entering character and takes the leaving one.
    Counts are packed, some bits each, into a few whole numbers, as a step writes the array anew.
    """
    bits = window.bit_length()
    held = 63 // bits  # counts in one number

    def unit(code: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code, F.lit(held)) * bits)

    def count(n: Column, code: Column) -> Column:
        packed = F.get(n, F.floor(code / held).cast("int"))
        return F.call_function("shiftright", packed, F.pmod(code, F.lit(held)) * bits).bitwiseAND((1 << bits) - 1).cast("int")

    def scan(codes: Column) -> Column:
        state = F.struct(F.array_repeat(F.lit(0).cast("long"), -(-128 // held)).alias("n"), F.lit(0.0).alias("s"),
                         F.lit(0).alias("first"), F.lit(0).alias("last"),
                         *([F.struct(*[F.lit(0).alias(g) for g in _GROUPS]).alias("seen")] if own else []))

        def step(state: Column, i: Column) -> Column:
            enter = F.element_at(codes, i)
            leave = F.when(i > window, F.element_at(codes, F.greatest(i - window, F.lit(1)))).otherwise(F.lit(-1))
            same = enter == leave
            c_in = count(state["n"], enter)
            c_out = F.when(leave >= 0, count(state["n"], F.greatest(leave, F.lit(0)))).otherwise(F.lit(0))
            s = F.when(same, state["s"]).otherwise(
                state["s"] - _c_log_c(c_in) + _c_log_c(c_in + 1)
                - F.when(leave >= 0, _c_log_c(c_out) - _c_log_c(c_out - 1)).otherwise(0.0))
            zero = F.lit(0).cast("long")
            counts = F.transform(state["n"], lambda c, j: c + F.when(j == F.floor(enter / held), unit(enter)).otherwise(zero)
                                 - F.when((leave >= 0) & (j == F.floor(leave / held)), unit(leave)).otherwise(zero))

            def judged(s: Column, limit: Column, *seen: Column) -> Column:
                bits = F.log2(F.lit(float(window))) - s / window
                strong = (i >= window) & (bits >= limit)
                return F.struct(counts.alias("n"), s.alias("s"),
                                F.when(strong & (state["first"] == 0), i).otherwise(state["first"]).alias("first"),
                                F.when(strong, i).otherwise(state["last"]).alias("last"), *[x.alias("seen") for x in seen])

            if not own:
                return let(s, lambda s: judged(s, threshold))
            seen = F.struct(*[F.when(enter.between(*map(ord, ends)) if ends else ~enter.between(48, 57) & ~enter.between(65, 90)
                                     & ~enter.between(97, 122), i).otherwise(state["seen"][g]).alias(g)
                              for g, ends in _GROUPS.items()])
            return let(s, lambda s: let(seen, lambda x: judged(s, _own_threshold(x, i - window, threshold, own), x)))

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), state, step,
                           lambda x: F.struct(x["first"].alias("first"), x["last"].alias("last")))

    codes = F.transform(F.split(candidate, ""), lambda c: F.ascii(c))
    return let(F.filter(codes, lambda c: c > 0), scan)


def _own_threshold(seen: Column, before: Column, threshold: Column, own: dict[str, float]) -> Column:
    """Threshold of the window after ``before`` by the groups seen in it; ``threshold`` unless digits and letters, both."""
    has = {g: seen[g] > before for g in _GROUPS}
    lower, upper = has["low_hex"] | has["low"], has["up_hex"] | has["up"]
    return (F.when(~has["digit"] | ~(lower | upper) | has["other"], threshold)
             .when(~has["low"] & ~has["up"] & ~(lower & upper), own["hex"])
             .when(~(lower & upper), own["plain"]).otherwise(own["mixed"]))


def _threshold(candidate: Column, thresholds: dict[str, float]) -> Column:
    return (F.when(candidate.rlike("^([0-9a-f]+|[0-9A-F]+)$"), thresholds["hex"])
             .when(candidate.rlike("^([^A-Z]+|[^a-z]+)$"), thresholds["plain"]).otherwise(thresholds["mixed"]))


def _spans(kind: int, found: Column) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                 thresholds: dict[str, float] | None = None, allowed: str = ALLOWED,
                 carry: str | None = None) -> DataFrame:
    """``[doc_id, text, assign, access, hex, entropy, parts]``: spans as ``array<struct<start, kind, end>>``.

    A column named by ``carry`` goes through as ``row``.
    """
    thresholds = thresholds or THRESHOLDS
    src = pick(docs, doc_id=id_col, text=text_col, **({"row": carry} if carry else {}))
    text = F.col("text")
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    assign = F.filter(matches(text, ASSIGN), lambda m: F.char_length(F.regexp_extract(m["found"], ASSIGN, 2)) >= 6)
    fixed = src.withColumns({
        "assign": F.when(text.rlike("(?i)passw|secret|token|api_?key"), _spans(0, assign)).otherwise(none),
        "access": F.when(text.contains("AKIA"), _spans(1, matches(text, ACCESS))).otherwise(none),
        "hex": F.when(text.rlike(HEX), _spans(2, matches(text, HEX))).otherwise(none)})

    def scanned(free: Column, own: dict[str, float] | None = None) -> Column:
        spans = F.transform(free, lambda m: let(
            strong_windows(m["found"], _threshold(m["found"], thresholds), window, own),
            lambda w: F.struct((m["start"] + w["first"] - window).alias("start"), F.lit(3).alias("kind"),
                               (m["start"] + w["last"]).alias("end"), w["first"].alias("first"))))
        return F.transform(F.filter(spans, lambda s: s["first"] > 0), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))

    def blanked(source: Column, cuts: Column, fill: str) -> Column:
        return replaced(source, cuts, lambda s: F.repeat(F.lit(fill), (s["end"] - s["start"]).cast("int")))

    def runs(source: str, pattern: str, own: dict[str, float] | None = None) -> Column:
        found = scanned(F.filter(matches(F.col(source), pattern), lambda m: ~m["found"].rlike(allowed)), own)
        return F.when(F.col(source).isNotNull(), found).otherwise(none)

    # A candidate needs a digit among its characters, which most prose lacks.
    likely = text.rlike("[0-9]") & text.rlike("(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+")
    base = F.concat("assign", "access", "hex")
    cuts = F.concat(base, F.when(text.rlike(HIDDEN), _spans(3, matches(text, HIDDEN))).otherwise(none))
    # What touches a fixed span lies beside its fill in the first text; no candidate holds the fill or a blank.
    # The texts are columns of their own, as expressions nested any deeper are not resolved.
    cut_up = fixed.withColumn("_cuts", F.when(likely, cuts)).withColumns({
        "_whole": F.when(likely, blanked(F.translate(text, FILL, " "), base, FILL)),
        "_parts": F.when(likely, blanked(text, F.col("_cuts"), " "))})
    return cut_up.withColumns({
        "entropy": runs("_whole", UNTOUCHED), "parts": runs("_parts", CANDIDATE, thresholds)}).drop("_cuts", "_whole", "_parts")


def named(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def merged(spans: Column) -> Column:
    """``array<struct<start, end>>`` by start; spans that touch or overlap become one."""
    def merge(s: Column, top: Column) -> Column:
        # A span that starts beyond every end before it is the head of a merged one.
        heads = F.filter(F.sequence(F.lit(0), F.size(s) - 1),
                         lambda i: (i == 0) | (F.get(s, i)["start"] > F.get(top, i - 1)))
        return let(heads, lambda h: F.zip_with(
            h, F.concat(F.slice(h, F.lit(2), F.size(h)), F.array(F.size(s))),
            lambda i, after: F.struct(F.get(s, i)["start"].alias("start"), F.get(top, after - 1).alias("end"))))

    ends = lambda s: running(F.transform(s, lambda x: x["end"]), lambda a, b: F.greatest(a, b))
    none = F.array().cast("array<struct<start:long,end:long>>")
    return F.when(F.size(spans) > 0, let(F.array_sort(spans), lambda s: let(ends(s), lambda top: merge(s, top)))).otherwise(none)


def strong_spans() -> Column:
    """The spans of ``entropy`` and ``parts`` as one array of the kind ``entropy``."""
    return F.transform(merged(F.concat("entropy", "parts")), lambda m: F.struct(
        m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end")))


def replaced(text: Column, spans: Column, mark: Callable[[Column], Column]) -> Column:
    """``text`` with every merged span replaced by what ``mark`` makes of it."""
    def rebuilt(m: Column, cut: Column) -> Column:
        pieces = F.transform(m, lambda s, i: F.concat(
            between(cut, F.coalesce(F.get(m, i - 1)["end"], F.lit(0)), s["start"]), mark(s)))
        rest = between(cut, F.element_at(m, -1)["end"], F.char_length(text))
        return F.concat(F.array_join(pieces, ""), rest)

    return F.when(F.size(spans) > 0, let(merged(spans), lambda m: let(blocks(text), lambda cut: rebuilt(m, cut)))).otherwise(text)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mark``; spans that touch or overlap become one."""
    return replaced(text, spans, lambda s: F.lit(mark))
