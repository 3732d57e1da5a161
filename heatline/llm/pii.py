"""Personal data: base formats, wide candidate generators, boosted trees that select among them.

Everything runs as column expressions and a fitted MLlib model; no Python runs on the executors.
"""

import re

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import bounded_sample, settle

KINDS = ("email", "ip", "card", "phone")
LOCAL, HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
# The base formats. Written without loops over groups, which recurse once per turn in Java and fail
# on long texts, and so that a failed start is not tried again from the middle of the same run.
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@(?=[{HOST}]++\.[{HOST}])[{HOST}][A-Za-z0-9.-]*?"
             r"(?=\.\.|\.?+(?![A-Za-z0-9.-]))",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
AT, DOT = r"(?:\x20?@\x20?|\x20?[\[({]at[\])}]\x20?|\x20at\x20)", r"(?:\.|\x20?[\[({]dot[\])}]\x20?|\x20dot\x20)"
# Wide generators: spelled-out and spaced addresses, odd separators, numbers without a plus.
WIDE = {
    "email": rf"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{{1,64}}+{AT}[A-Za-z0-9-]{{1,63}}+(?:{DOT}[A-Za-z0-9-]{{1,63}}+){{1,4}}",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\)|\x20\.\x20|,)[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])[+(]{0,2}[0-9](?:[\x20()./-]{0,2}[0-9]){6,14}(?![0-9A-Za-z])",
}
CONTEXT = 24
BLOCK = 256
CUES = {"email": "mail|contact|write|reach|@", "ip": "ip|host|server|address|addr|from",
        "card": "card|visa|credit|debit|pay|iban|account", "phone": "phone|tel|call|mobile|cell|fax|contact"}
SAMPLE = 6000
TREES, DEPTH = 10, 3
PRECISION = 0.98
VALIDATION = 4
SEED = 11
SPAN = "struct<start:int,end:int,hit:string,before:string,after:string>"


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


#: What a text must hold for a generator to be worth running.
NEEDS = {
    ("base", "email"): "instr(_text, '@') > 0", ("base", "ip"): "_digits", ("base", "card"): "_digits",
    ("base", "phone"): "instr(_text, '+') > 0",
    ("wide", "email"): f"_text rlike {literal('(?i)' + AT)}",
    ("wide", "ip"): "_digits", ("wide", "card"): "_digits", ("wide", "phone"): "_digits",
}


def let(name: str, value: str, kind: str, body: str) -> str:
    """SQL: `body`, of type `kind`, with `value` computed once under a name."""
    return f"aggregate(array({value}), cast(null as {kind}), (none, {name}) -> {body})"


def occurrences(pattern: str, needed: str) -> str:
    """SQL: array of (start, end, hit, before, after) of all matches in `_text`, in code points.

    Positions are running sums of the lengths of matches and of the gaps between them. They are taken
    in blocks of 256 matches, as an array that grows by one is copied each time.
    """
    kind = f"array<{SPAN}>"
    found = (f"named_struct('hits', regexp_extract_all(_text, {literal(pattern)}, 0), "
             f"'gaps', split(_text, {literal(pattern)}, -1))")
    blocks = f"sequence(0, int((size(m.hits) - 1) / {BLOCK}))"
    inside = f"sequence(b * {BLOCK}, least(size(m.hits), (b + 1) * {BLOCK}) - 1)"
    lengths = f"""transform({blocks}, b -> aggregate({inside}, 0,
        (sum, k) -> sum + length(m.gaps[k]) + length(m.hits[k])))"""
    offsets = """aggregate(lengths, named_struct('at', 0, 'out', cast(array() as array<int>)),
        (acc, n) -> named_struct('at', acc.at + n, 'out', concat(acc.out, array(acc.at))), acc -> acc.out)"""
    spans = f"""flatten(transform({blocks}, b -> aggregate({inside},
        named_struct('at', offsets[b], 'out', cast(array() as {kind})),
        (acc, k) -> named_struct(
          'at', acc.at + length(m.gaps[k]) + length(m.hits[k]),
          'out', concat(acc.out, array(named_struct(
            'start', acc.at + length(m.gaps[k]), 'end', acc.at + length(m.gaps[k]) + length(m.hits[k]),
            'hit', m.hits[k], 'before', right(m.gaps[k], {CONTEXT}), 'after', left(m.gaps[k + 1], 1))))),
        acc -> acc.out)))"""
    counted = let("lengths", lengths, kind, let("offsets", offsets, kind, spans))
    some = f"if(size(m.hits) = 0, cast(array() as {kind}), {counted})"
    return f"if({needed}, {let('m', found, kind, some)}, cast(array() as {kind}))"


DIGITS = "regexp_replace(s.hit, '[^0-9]', '')"
LUHN_SUM = ("aggregate(sequence(1, length({d})), 0, (sum, i) -> sum + if(i % 2 = 1, int(substring({d}, -i, 1)), "
            "element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), int(substring({d}, -i, 1)) + 1)))")
LUHN = LUHN_SUM + " % 10 = 0"
VALID = {
    "email": "true",
    "ip": "forall(split(s.hit, '[.]'), p -> length(ltrim('0', p)) <= 3 and int(concat('0', ltrim('0', p))) <= 255)",
    "card": LUHN.format(d=DIGITS),
    "phone": f"length({DIGITS}) between 8 and 15",
}

#: Features of a wide candidate `s` of kind number `k`: format, then context.
FEATURES = {
    "kind": "double(k)",
    "length": "double(length(s.hit))",
    "digits": f"double(length({DIGITS}))",
    "separators": "double(length(regexp_replace(s.hit, '[0-9A-Za-z]', '')))",
    "letters": "double(length(regexp_replace(s.hit, '[^A-Za-z]', '')))",
    "dots": "double(length(s.hit) - length(replace(s.hit, '.', '')))",
    "groups": "double(size(split(s.hit, '[^0-9A-Za-z]+')))",
    "longest": "double(array_max(transform(split(s.hit, '[^0-9]+'), p -> length(p))))",
    "last_group": "double(length(element_at(split(s.hit, '[^0-9A-Za-z]+'), -1)))",
    "first_group": "double(coalesce(length(get(regexp_extract_all(s.hit, '[0-9]+', 0), 0)), 0))",
    "second_group": "double(coalesce(length(get(regexp_extract_all(s.hit, '[0-9]+', 0), 1)), 0))",
    "lead": f"double(int(concat('0', left({DIGITS}, 2))))",
    "time": "if(regexp_replace(s.hit, '[^0-9]', '') rlike "
            "'^(1[5-7][0-9]{8}([0-9]{3})?|(19|20)[0-9]{2}(0[1-9]|1[0-2])[0-3][0-9].*|[0-3][0-9](0[1-9]|1[0-2])(19|20)[0-9]{2})$', "
            "1D, 0D)",
    "marks": "double(size(split(s.hit, {})) - 1)".format(literal(r"(?i)@|[\[({]at[\])}]|[\[({\x20]dot[\])}\x20]")),
    "local": "double(length(regexp_replace(regexp_extract(s.hit, '^[A-Za-z0-9._%+-]*', 0), '[A-Za-z]', '')))",
    "luhn": f"if(length({DIGITS}) > 1 and {LUHN.format(d=DIGITS)}, 1D, 0D)",
    "small_parts": "if(forall(split(s.hit, '[^0-9]+'), p -> length(p) <= 3 and int(concat('0', p)) <= 255), 1D, 0D)",
    "touches_before": "if(right(s.before, 1) rlike '[0-9A-Za-z=\"#/_.:-]', 1D, 0D)",
    "touches_after": "if(s.after rlike '[0-9A-Za-z=\"/_-]', 1D, 0D)",
    "cue": "if(s.before rlike element_at(array({cues}), k + 1), 1D, 0D)".format(
        cues=", ".join(literal(f"(?i)({CUES[k]})") for k in KINDS)),
}

def regrouped(digits: str, sizes: list[int], mark: str) -> str:
    """SQL: the first digits in groups of these sizes; the last group takes the rest where its size is 0."""
    parts, at = [], 1
    for size in sizes:
        parts.append(f"substring({digits}, {at}, {size})" if size else f"substring({digits}, {at})")
        at += size
    return f"concat_ws('{mark}', {', '.join(parts)})"


def swapped(hit: str, pattern: str, mark: str) -> str:
    return f"regexp_replace({hit}, {literal(pattern)}, {literal(mark)})"


def checked(digits: str) -> str:
    """SQL: the digits and their check digit."""
    total = LUHN_SUM.format(d=f"concat({digits}, '0')")
    return f"concat({digits}, pmod(-({total}), 10))"


def spelled(local: str, at: str, dot: str) -> str:
    return f"concat({local}, '{at}', {swapped(HOSTED, '[.]', dot)})"


NAME, HOSTED = "substring_index(s.hit, '@', 1)", "substring_index(s.hit, '@', -1)"
PLAIN_NAME = f"concat('x', {swapped(NAME, '[^A-Za-z]', '')})"
LAST_WORD = "regexp_extract(concat(' look ', s.before), '([A-Za-z]+)[^A-Za-z]*$', 1)"
# A phone number without its country code, where a mark or bracket ends that.
NATIONAL = swapped("s.hit", r"^\+[0-9]{1,3}(?:[\x20.-]+|(?=\())", "")
NATIONAL_DIGITS = swapped(NATIONAL, "[^0-9]", "")
JOINED = swapped(NATIONAL, "^[^0-9]+", "")
SPELLINGS = ((" at ", " dot "), (" [at] ", " [dot] "), ("[at]", "[dot]"), (" (at) ", " (dot) "), ("(at)", "."),
             (" [at] ", "."), (" @ ", "."), ("@", " dot "), ("@", "."))
CARD_MARKS = ("", " ", "-", ".", "/", "_")
AMEX = checked(f"concat('37', substring({DIGITS}, 3, 12))")
OCTETS = "regexp_replace(s.hit, '^[0-9]+', {})"

#: The wide forms of a valid base hit `s`: what is personal.
FORMS = {
    "email": [spelled(n, at, dot) for n in (NAME, PLAIN_NAME) for at, dot in SPELLINGS] + [spelled(NAME, " at ", ".")],
    "ip": [swapped("s.hit", "[.]", m) for m in (".", "[.]", "(.)", " . ")],
    "card": ["s.hit", *[regrouped(DIGITS, [4, 4, 4, 0], m) for m in CARD_MARKS]],
    "phone": ["s.hit", "substring(s.hit, 2)", NATIONAL, NATIONAL_DIGITS, DIGITS,
              *[swapped(f, "[^0-9]+", m) for f in (JOINED, "substring(s.hit, 2)") for m in ("-", ".", " ", "/")]],
}

WRONG_DIGIT = f"concat(left({DIGITS}, length({DIGITS}) - 1), (int(right({DIGITS}, 1)) + 1) % 10)"
YEAR, MONTH, DAY = (f"lpad({low} + int(right({DIGITS}, {n})) % {size}, {width}, '0')"
                    for low, n, size, width in ((1950, 3, 90, 4), (1, 2, 12, 2), (1, 4, 28, 2)))
DATES = [f"concat_ws('{m}', {parts})" for m in ("-", "/", ".", " ", "")
         for parts in (f"{YEAR}, {MONTH}, {DAY}", f"{DAY}, {MONTH}, {YEAR}")]
SECONDS = f"concat('1', 5 + int(right({DIGITS}, 1)) % 3, left(right({DIGITS}, 9), 8))"
#: Formats that fail, made from a base hit: an ordinary "at", lists, numbers out of range, wrong check
#: digits, times in seconds and milliseconds, dates, years, amounts, decimals, book numbers, too few digits.
FAILING = {
    "email": [f"concat({LAST_WORD}, ' at ', {HOSTED})", f"concat({LAST_WORD}, ' at ', {PLAIN_NAME}, '.', {LAST_WORD})",
              f"concat({PLAIN_NAME}, ' at ', {HOSTED})", f"concat({LAST_WORD}, ' at a.', {LAST_WORD})"],
    "ip": [swapped("s.hit", "[.]", ","), *[swapped(OCTETS.format("'999'"), "[.]", m) for m in (".", "[.]", "(.)", " . ", ",")],
           *[swapped("regexp_replace(s.hit, '[0-9]+$', '300')", "[.]", m) for m in (".", "[.]", "(.)", " . ")]],
    "card": [*[regrouped(WRONG_DIGIT, [4, 4, 4, 0], m) for m in CARD_MARKS],
             *[regrouped(f"concat(left({AMEX}, 14), (int(right({AMEX}, 1)) + 1) % 10)", [4, 6, 5], m) for m in CARD_MARKS],
             checked(f"concat('17', substring({DIGITS}, 3, 10))"), checked(f"concat('20', substring({DIGITS}, 3, 11))"),
             f"trim(regexp_replace({DIGITS}, '([0-9])', '$1 '))"],
    "phone": [*DATES, f"concat({YEAR}, '-', {MONTH}, '-', {DAY}, ' ', {MONTH})",
              f"concat({YEAR}, {MONTH}, {DAY}, {DAY}, {MONTH}, {DAY})", f"concat({YEAR}, ' ', {YEAR})",
              f"concat({YEAR}, '-', {YEAR})", SECONDS, f"concat({SECONDS}, right({DIGITS}, 3))",
              *[f"left({NATIONAL_DIGITS}, {n})" for n in (7, 8, 9)], regrouped(f"left({NATIONAL_DIGITS}, 7)", [3, 0], "-"),
              *[regrouped(f"left({NATIONAL_DIGITS}, {n})", sizes, m) for m in (" ", ".")
                for n, sizes in ((7, [1, 3, 3]), (8, [2, 3, 3]), (9, [3, 3, 3]), (10, [1, 3, 3, 3]), (8, [4, 4]))],
              *[regrouped(f"concat('4', {DIGITS}, '0000')", [4, 4, 4], m) for m in (" ", "-", ".", "/")],
              *[regrouped(NATIONAL_DIGITS, [n, 0], ".") for n in (1, 2, 3, 4)],
              regrouped(f"concat('978', {DIGITS})", [3, 1, 2, 6, 1], "-"),
              regrouped(f"concat('999', {NATIONAL_DIGITS})", [3, 3, 3, 3], "."),
              f"trim(regexp_replace({DIGITS}, '([0-9])', '$1 '))"],
}
#: Valid whatever the base hit: cards of 15 digits.
MADE = {"card": [regrouped(AMEX, [4, 6, 5], m) for m in CARD_MARKS]}
#: Marks that make a number a part of something longer.
GLUED = "array('/', '#', '_')"


def prepared(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.withColumn("_text", body).withColumn("_digits", F.expr("_text rlike '[0-9]'"))


def with_base(docs: DataFrame, text="text") -> DataFrame:
    """`docs` with `_base`: array of (kind, start, end), kinds in their fixed order, then by start."""
    out = prepared(docs, text)
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", F.expr(occurrences(BASE[kind], NEEDS["base", kind])))
    valid = [f"transform(filter(_{kind}, s -> {VALID[kind]}), s -> named_struct('k', {k}, 'start', s.start, 'end', s.end))"
             for k, kind in enumerate(KINDS)]
    return out.withColumn("_base", F.expr(f"concat({', '.join(valid)})")).drop(*[f"_{k}" for k in KINDS])


def featured(k: int, array: str, *more: str) -> str:
    """SQL: the candidates of an array with their features, and what else is asked for."""
    fields = [f"'{name}', {re.sub(r'\bk\b', str(k), sql) if name in ('kind', 'cue') else sql}"
              for name, sql in FEATURES.items()]
    return f"transform({array}, s -> named_struct('k', {k}, {', '.join([*more, *fields])}))"


def with_candidates(docs: DataFrame) -> DataFrame:
    """`_wide`: array of (k, start, end, features), for rows that have `_text` and `_base`."""
    out = docs
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", F.expr(occurrences(WIDE[kind], NEEDS["wide", kind])))
    parts = [featured(k, f"_{kind}", "'start', s.start", "'end', s.end") for k, kind in enumerate(KINDS)]
    return out.withColumn("_wide", F.expr(f"concat({', '.join(parts)})")).drop(*[f"_{k}" for k in KINDS])


def taught(docs: DataFrame, text="text") -> DataFrame:
    """Rows (_id, k, label, features): the wide forms of valid base hits, and formats that fail.

    Base hits that fail their own test are failing formats as they stand. Only forms that the wide
    generator of the kind takes whole teach anything.
    """
    out = prepared(docs, text)
    for kind in KINDS:
        out = out.withColumn(f"_{kind}", F.expr(occurrences(BASE[kind], NEEDS["base", kind])))
    shown = "'hit', {}, 'before', {}, 'after', s.after, 'label', {}"
    made = []
    for k, kind in enumerate(KINDS):
        rows = [shown.format(sql, "s.before", f"if({VALID[kind]}, 1D, 0D)") for sql in FORMS[kind]]
        rows += [shown.format(sql, "s.before", "0D") for sql in FAILING[kind]]
        rows += [shown.format(sql, "s.before", "1D") for sql in MADE.get(kind, [])]
        if kind == "phone":
            rows.append(shown.format(NATIONAL_DIGITS, f"concat(s.before, {GLUED}[int(right({DIGITS}, 1)) % 3])", "0D"))
        each = f"transform(_{kind}, s -> array({', '.join(f'named_struct({r})' for r in rows)}))"
        whole = f"filter(flatten({each}), s -> s.hit rlike {literal('^(?:' + WIDE[kind] + ')$')})"
        out = out.withColumn(f"_made_{kind}", F.expr(whole))
        made.append(featured(k, f"_made_{kind}", "'label', s.label"))
    return out.select("_id", F.explode(F.expr(f"concat({', '.join(made)})")).alias("c")).select("_id", "c.*")


def tree_sql(text: str, field) -> str:
    """One fitted regression tree, from its printed form, as a CASE expression."""
    lines = [line.strip() for line in text.splitlines() if line.strip().startswith(("If", "Else", "Predict"))]

    def node(at):
        line = lines[at]
        if line.startswith("Predict"):
            return f"({float(line.split(':')[1])!r}D)", at + 1
        index, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        yes, at = node(at + 1)
        no, at = node(at + 1)
        return f"(case when {field(int(index))} <= {float(limit)!r}D then {yes} else {no} end)", at

    return node(0)[0]


class Selector:
    """Boosted trees as SQL over a candidate `c`, and the least margin that is selected, per kind."""

    def __init__(self, margins: dict[int, str], limits: dict[int, float]):
        self.margins, self.limits = margins, limits

    def chosen(self) -> str:
        tests = [f"(c.k = {k} and {self.margins[k]} >= {limit!r}D)" for k, limit in self.limits.items()]
        return " or ".join(tests) or "false"


def fit(docs: DataFrame, row_id="doc_id", text="text", sample=SAMPLE) -> Selector:
    """Learn to select candidates from at most `sample` rows, chosen by a hash of the id.

    Valid base hits, rewritten into the wide forms (`FORMS`), teach "personal"; formats that fail
    (`FAILING`), made from the same hits, teach "not". Candidates that no base span covers teach
    nothing: nobody knows what they are. Each kind has its own trees, to which both answers weigh the
    same in sum. On a quarter of the rows each kind
    gets the least margin at which 98 in 100 selected candidates are personal; a kind without such a
    margin, or without a base hit in the sample, selects nothing.
    """
    rows = bounded_sample(docs.where(F.col(text).isNotNull()), row_id, sample, "pii").limit(sample)
    names = list(FEATURES)
    data = settle(VectorAssembler(inputCols=names, outputCol="features").transform(
        taught(rows.select(F.col(row_id).alias("_id"), text), text)
        .withColumn("test", F.pmod(F.xxhash64("_id"), F.lit(VALIDATION)) == 0))
        .select("label", "k", "test", "features", *names))
    seen = {tuple(r) for r in data.select("k", "test", "label").distinct().collect()}
    margins, limits = {}, {}
    for k in range(len(KINDS)):
        if not {(k, False, 0.0), (k, False, 1.0), (k, True, 1.0)} <= seen:
            continue
        own = data.where(F.col("k") == k)
        lessons = own.where("not test").select("label", "features")
        n = {r.label: r["count"] for r in lessons.groupBy("label").count().collect()}
        lessons = lessons.withColumn("weight", F.when(F.col("label") == 1, F.lit(n[0.0] / n[1.0])).otherwise(F.lit(1.0)))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=2, weightCol="weight").fit(lessons)
        margin = " + ".join(f"{w!r}D * {tree_sql(t.toDebugString, lambda i: 'c.`' + names[i] + '`')}"
                            for t, w in zip(model.trees, model.treeWeights))
        scored = own.where("test").select("label", F.expr(margin.replace("c.`", "`")).alias("m"))
        good = n = 0.0
        for r in scored.groupBy(F.round("m", 6).alias("m")).agg(F.sum("label").alias("good"), F.count("*").alias("n")) \
                .orderBy(F.desc("m")).collect():
            good, n = good + r.good, n + r.n
            if r.m > 0 and good >= PRECISION * n:
                margins[k], limits[k] = f"({margin})", r.m - 1e-6
    return Selector(margins, limits)


def detect(docs: DataFrame, selector: Selector, text="text") -> DataFrame:
    """`docs` with `_base` and `_spans`: arrays of (k, start, end), by kind and start.

    `_spans` holds all base spans and the selected candidates that touch no base span; where those
    overlap one another the first, and of equal starts the longest, stays.
    """
    based = with_base(docs, text)
    if not selector.limits:
        return based.withColumn("_spans", F.col("_base")).drop("_text", "_digits")
    more = f"""aggregate(
        array_sort(transform(filter(filter(_wide, c -> {selector.chosen()}),
                                    c -> not exists(_base, b -> b.start < c.end and c.start < b.end)),
                             c -> named_struct('start', c.start, 'less', -c.end, 'k', c.k))),
        named_struct('at', 0, 'out', cast(array() as array<struct<k:int,start:int,end:int>>)),
        (acc, c) -> if(c.start >= acc.at, named_struct('at', -c.less,
            'out', concat(acc.out, array(named_struct('k', c.k, 'start', c.start, 'end', -c.less)))), acc),
        acc -> acc.out)"""
    return (with_candidates(based).withColumn("_more", F.expr(more))
            .withColumn("_spans", F.expr("array_sort(concat(_base, _more))"))
            .drop("_more", "_wide", "_text", "_digits"))


def listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat_ws(':', array({names})[s.k], s.start, s.end)), ',')"


def report(docs: DataFrame, row_id="doc_id", text="text", selector: Selector | None = None) -> DataFrame:
    """Counts, the digest of the base spans and all spans, per row of `docs`.

    A NULL text counts as empty and has no span. Repeated rows are returned as often as they come, ids
    may be NULL, other columns are ignored, an empty table gives an empty result. Spans are in code
    points, end exclusive.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    selector = selector or fit(rows)
    counts = [F.expr(f"cast(size(filter(_base, s -> s.k = {k})) as bigint)").alias(f"n_{kind}")
              for k, kind in enumerate(KINDS)]
    return detect(rows, selector).select(
        "doc_id", *counts, F.sha2(F.expr(listed("_base")).cast("binary"), 256).alias("base_sha256"),
        F.expr(listed("_spans")).alias("spans"))


def redact(docs: DataFrame, selector: Selector, text="text") -> DataFrame:
    """`docs` with every span of its text replaced by its kind in square brackets.

    Spans that overlap are replaced as one, by the kind of the first. NULL texts stay NULL; all other
    columns and the number of rows stay.
    """
    names = ", ".join(f"'[{k.upper()}]'" for k in KINDS)
    merged = """aggregate(array_sort(transform(_spans, s -> named_struct('start', s.start, 'less', -s.end, 'k', s.k))),
        cast(array() as array<struct<start:int,end:int,k:int>>),
        (acc, s) -> if(size(acc) > 0 and s.start < element_at(acc, -1).end,
            concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start,
                'end', greatest(element_at(acc, -1).end, -s.less), 'k', element_at(acc, -1).k))),
            concat(acc, array(named_struct('start', s.start, 'end', -s.less, 'k', s.k)))))"""
    rebuilt = f"""if(size(_merged) = 0, text, aggregate(_merged, named_struct('at', 0, 'out', ''),
        (acc, s) -> named_struct('at', s.end, 'out', concat(acc.out, substring(text, acc.at + 1, s.start - acc.at),
            element_at(array({names}), s.k + 1))),
        acc -> concat(acc.out, substring(text, acc.at + 1))))"""
    whole = docs.select(F.struct("*").alias("row"), F.col(text).cast("string").alias("text"))
    clean = detect(whole, selector).withColumn("_merged", F.expr(merged)).withColumn("_clean", F.expr(rebuilt))
    return clean.select(*[F.col("_clean").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
