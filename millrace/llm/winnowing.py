"""Document fingerprints by winnowing, and how much of a fingerprint survives an edit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.sql import CRC, CRC_TABLE, WORDS
from millrace.llm.work import Scratch, words

# A gram is GRAM consecutive words; each window of WINDOW consecutive grams keeps its least hash. So any
# run of GRAM + WINDOW - 1 words that two texts share gives both of them a common fingerprint.
GRAM, WINDOW = 5, 8
# A gram is the polynomial of its words' crc32 codes in BASE, modulo a Mersenne prime. A
# product of two residues stays below 2**62, and so does a hash with its place in the low bits.
PRIME, BASE = (1 << 31) - 1, 1_000_003
PLACES = 1 << 31
# Ranges of neighbouring ids for each shuffle partition.
RANGES = 8
LONGS = "array<long>"


def _with_grams(df: DataFrame, text: str, k: int) -> DataFrame:
    """Add ``__grams``: the rolling polynomial hash of every run of ``k`` words of a text column.

    Put together by doubling: a run of a + b words is the run of its first a words times BASE**b plus
    the run of its last b, so k words cost about log2(k) steps, not k. A text of fewer than k words,
    but not none, is one gram. Each step is a column of its own, so none is computed twice.
    """
    df = df.withColumn("__g1", F.transform(words(F.col(text)), lambda w: F.crc32(w.cast("binary")) % PRIME))
    have = [1]

    def join(df: DataFrame, a: int, b: int) -> DataFrame:
        left, right = F.col(f"__g{a}"), F.col(f"__g{b}")
        size = F.greatest(F.size(right) - a, F.lit(0))
        lift = F.lit(pow(BASE, b, PRIME))
        run = F.zip_with(F.slice(left, 1, size), F.slice(right, a + 1, size), lambda x, y: (x * lift + y) % PRIME)
        have.append(a + b)
        return df.withColumn(f"__g{a + b}", run)

    while have[-1] * 2 <= k:
        df = join(df, have[-1], have[-1])
    for size in sorted(have, reverse=True):
        if have[-1] + size <= k:
            df = join(df, have[-1], size)
    one = F.aggregate("__g1", F.lit(0).cast("long"), lambda acc, x: (acc * BASE + x) % PRIME)
    grams = F.when(F.size("__g1") >= k, F.col(f"__g{k}")).when(F.size("__g1") > 0, F.array(one))
    return df.withColumn("__grams", F.coalesce(grams, F.array().cast(LONGS))).drop(*[f"__g{n}" for n in have])


def with_marks(df: DataFrame, text: str, out: str, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Add ``out``: the chosen grams of a text column as longs, hash above and place below.

    The place counts down in the low bits, so the least long of a window is its least hash and, of
    equal ones, the rightmost. Window minima are doubled as well (a minimum may be taken twice). Fewer
    grams than a window are one window. In order of place, each gram once.
    """
    df = _with_grams(df, text, k)
    df = df.withColumn("__m", F.transform("__grams", lambda x, i: x * PLACES + (PLACES - 1 - i)))
    width = 1
    while width < w:
        step = min(width, w - width)
        size = F.size("__m") - step
        # Rows with fewer grams than a window have stopped at their last possible step: one minimum.
        least = F.zip_with(F.slice("__m", 1, size), F.slice("__m", step + 1, size), lambda x, y: F.least(x, y))
        whole = F.when(F.size("__m") > 0, F.array(F.array_min("__m"))).otherwise(F.col("__m"))
        df = df.withColumn("__m", F.when(size > 0, least).otherwise(whole))
        width += step
    return df.withColumn(out, F.array_distinct("__m")).drop("__m", "__grams")


def hashes(marks: Column) -> Column:
    """The distinct gram hashes of marks, without their places."""
    return F.array_distinct(F.transform(marks, lambda c: F.shiftright(c, 31)))


def places(marks: Column) -> Column:
    """Marks as ``{pos, hash}``: the number of the gram's first word, from 0, and its hash."""
    return F.transform(
        marks,
        lambda c: F.struct(
            (F.lit(PLACES - 1) - c.bitwiseAND(F.lit(PLACES - 1))).cast("int").alias("pos"),
            F.shiftright(c, 31).alias("hash"),
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes of two sets; two empty sets are alike."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def fingerprint(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """``doc_id`` and ``fingerprint``: the winnowed grams of the whole text as ``[{pos, hash}]``.

    Words are lower-cased (A-Z) runs of letters, digits and non-ASCII characters. Texts that share a run
    of ``k + w - 1`` words share a hash, at the places both fingerprints tell; nothing shorter than k
    words matches, but texts of fewer words are one gram. Equal texts have equal fingerprints; null,
    empty and wordless texts have an empty one. Every row stands for itself, so ids may repeat or be
    null, an empty table stays empty, and other columns are ignored. Nothing is shuffled.
    """
    marked = with_marks(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "__marks", k, w)
    return marked.select("doc_id", places(F.col("__marks")).alias("fingerprint"))


def _search(pivots: Column, key: Column) -> Column:
    """How many of the sorted pivots are not above the key, by halving steps."""
    steps = F.array(*[F.lit(1 << s) for s in range(24, -1, -1)])

    def grow(at: Column, step: Column) -> Column:
        last = F.get(pivots, F.least(at + step, F.size(pivots)) - 1)
        return F.when((at + step <= F.size(pivots)) & (last <= key), at + step).otherwise(at)

    return F.aggregate(F.filter(steps, lambda s: s <= F.size(pivots)), F.lit(0), grow)


def _key() -> Column:
    """Ascending where ids descend: null ids last, and equal ids by their text's hash."""
    return F.struct(
        F.col("doc_id").isNull().alias("none"),
        F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0)).alias("id"),
        F.xxhash64("text").alias("h"),
    )


def in_ranges(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows dealt out by ranges of their key, each range followed by the first row of the next one.

    The ranges begin at rows chosen by a hash of their key, in proportion to the rows, so their number
    follows the session's shuffle partitions. A row that begins a range is also sent, as a guest, to the
    end of the range before it, and the very first row to the end of the last: so every row finds its
    successor within its own range. Rows with one id but different texts are cut into ranges like
    others; only full repeats (id and text) stay side by side, and sorting and windows spill.
    """
    spark = docs.sparkSession
    share = max(1, docs.count() // (RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keys = docs.select(_key().alias("key"))
    chosen = F.when(F.pmod(F.xxhash64(F.lit(12), "key.none", "key.id", "key.h"), F.lit(share)) == 0, F.col("key"))
    found = scratch.keep(keys.agg(F.array_sort(F.collect_set(chosen)).alias("pivots"), F.min("key").alias("first")))
    cuts = found.select(F.struct("pivots", "first").alias("cuts")).scalar()
    placed = docs.withColumn("key", _key()).withColumn("cuts", cuts)
    at = _search(F.col("cuts.pivots"), F.col("key"))
    begins = (F.col("at") > 0) & (F.get("cuts.pivots", F.col("at") - 1) == F.col("key"))
    homes = F.array_compact(
        F.array(
            F.struct(F.col("at").alias("range"), F.lit(False).alias("guest")),
            F.when(begins, F.struct((F.col("at") - 1).alias("range"), F.lit(True).alias("guest"))),
            F.when(
                F.col("key") == F.col("cuts.first"),
                F.struct(F.size("cuts.pivots").alias("range"), F.lit(True).alias("guest")),
            ),
        )
    )
    sent = placed.withColumn("at", at).select("doc_id", "text", "key", F.explode(homes).alias("home"))
    return (
        sent.select("doc_id", "text", "key", "home.range", "home.guest")
        .repartition("range")
        .sortWithinPartitions("range", "guest", "key")
    )


def edit_marks(docs: DataFrame, k: int = GRAM, w: int = WINDOW) -> DataFrame:
    """Every document beside its edit: its last half replaced by the beginning of the next document.

    The next document is the one with the next smaller id (after the smallest: the largest); the last
    ``floor(n / 2)`` code points go, and as many of the next text's first ones (or all) come. Columns:
    ``doc_id``, ``n_chars``, ``edited`` (the text), ``marks`` and ``edited_marks``, and the likeness of
    the fingerprint to the edit's (``near_edited``) and to the next document's (``near_next``), from the
    sets of hashes; two empty sets are alike.

    A null text is empty. Rows with one id follow each other by their text's hash, full repeats in any
    order (their rows differ in nothing else, so the result as a whole is the same); null ids come last.
    A single row follows itself; an empty table stays empty. Other columns are ignored. The texts are
    shuffled once.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = with_marks(in_ranges(rows, Scratch(docs.sparkSession)), "text", "marks", k, w)
    following = Window.partitionBy("range").orderBy("guest", "key")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next.text", F.lit(1), half)
    )
    paired = (
        marked.withColumn("next", F.lead(F.struct("text", "marks")).over(following))
        .filter(~F.col("guest"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn("edited", edited)
    )
    both = with_marks(paired, "edited", "edited_marks", k, w)
    own = both.withColumn("__own", hashes(F.col("marks")))
    return own.select(
        "doc_id",
        "n_chars",
        "edited",
        "marks",
        "edited_marks",
        likeness(F.col("__own"), hashes(F.col("edited_marks"))).alias("near_edited"),
        likeness(F.col("__own"), hashes(F.col("next.marks"))).alias("near_next"),
    )


def _listed(marks: Column) -> Column:
    return F.array_join(F.transform(places(marks), lambda p: F.concat_ws(":", p["pos"], p["hash"])), ",")


def digest(edited: DataFrame) -> DataFrame:
    """Fingerprints as ``pos:hash`` lists, and the edited text's hash."""
    return edited.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        _listed(F.col("marks")).alias("fingerprint"),
        _listed(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def oracle(k: int = GRAM, w: int = WINDOW) -> str:
    """The digest of ``documents`` in DuckDB SQL; ids are taken to differ."""
    poly = "g[i + 1]"
    for j in range(1, k):
        poly = f"(({poly}) * {BASE} + g[i + {j + 1}]) % {PRIME}"
    listed = "array_to_string(list_transform({0}, lambda m: m.pos || ':' || m.hash), ',')"
    alike = (
        "case when len(list_distinct(a || b)) = 0 then 1.0::double "
        "else len(list_intersect(a, b))::double / len(list_distinct(a || b)) end"
    )

    def likeness_of(other: str) -> str:
        left, right = (f"list_transform({m}, lambda m: m.hash)" for m in ("o.marks", other))
        return alike.replace("(a, b)", f"({left}, {right})").replace("a || b", f"{left} || {right}")

    return f"""with {CRC_TABLE},
docs as (select doc_id, coalesce(text, '') as text,
 coalesce(lead(doc_id) over (order by doc_id desc), max(doc_id) over ()) as next_id from documents),
pairs as (select d.doc_id, d.next_id, d.text, length(d.text) as n,
 substr(d.text, 1, length(d.text) - length(d.text) // 2) || substr(n.text, 1, length(d.text) // 2) as edited
 from docs d join docs n on n.doc_id = d.next_id),
texts as (select text from pairs union select edited from pairs),
split as (select text, {WORDS.format("text")} as ws from texts),
codes as (select word, {CRC.format("word")} % {PRIME} as code
 from (select distinct unnest(ws) as word from split), crc_table),
placed as (select text, unnest(ws) as word, generate_subscripts(ws, 1) as i from split),
coded as (select text, list(code order by i) as g from placed join codes using (word) group by text),
grams as (select text, case when len(g) < {k}
  then [list_reduce(g, lambda acc, x: (acc * {BASE} + x) % {PRIME}, 0::bigint)]
  else list_transform(range(len(g) - {k - 1}), lambda i: {poly}) end as g from coded),
keyed as (select text, list_transform(g, lambda x, i: x * {PLACES} + {PLACES} - i) as m from grams),
least as (select text, list_transform(range(greatest(len(m) - {w - 1}, 1)), lambda i: list_min(m[i + 1:i + {w}])) as m from keyed),
marked as (select text, list_sort(list_distinct(list_transform(m, lambda c:
  {{'pos': {PLACES - 1} - (c & {PLACES - 1}), 'hash': c >> 31}}))) as marks from least),
every as (select s.text, coalesce(m.marks, []) as marks from split s left join marked m using (text))
select p.doc_id, p.n as n_chars, sha256(p.edited) as edited_sha256,
 {listed.format("o.marks")} as fingerprint, {listed.format("e.marks")} as edited_fingerprint,
 {likeness_of("e.marks")} as near_edited, {likeness_of("x.marks")} as near_next
from pairs p join every o on o.text = p.text join every e on e.text = p.edited
join docs n on n.doc_id = p.next_id join every x on x.text = n.text"""
