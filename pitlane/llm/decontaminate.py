"""Benchmark decontamination by template canonicalisation, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words in a template window; an item of fewer words is one window, if it has SHORTEST at least.
WINDOW, SHORTEST = 8, 4
#: Window starts in a piece of a text.
PIECE = 256
#: A window counts if this part of its words, at least, are no placeholders.
LITERAL = 0.5
#: A document holds an item if its windows cover this part of the item's words, or RUN words of it in a row.
COVER, RUN = 0.5, 13
#: Benchmark windows up to this number are broadcast (about 200 bytes each); more are joined by a shuffle.
BROADCAST_WINDOWS = 200_000
#: Words that are units when they follow a number. Fixed values.
UNITS = ("mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l s sec second seconds min minute minutes h hr hrs hour hours day days week weeks month months year years "
         "mile miles meter meters metre metres foot feet inch inches gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres gallon gallons "
         "percent dollar dollars cent cents euro euros usd eur mph kmh kph hz khz mhz ghz kb mb gb tb kw w v c f").split()

#: A placeholder word is this mark, a letter for its type (n, p or u), and the value.
_MARK = "\u0001"
_BREAKS = r"[\x00\x02-\x2F\x3A-\x60\x7B-\x7F«»‐-⁞　-〿]+"


def template_words(text: Column) -> Column:
    """Words of a text, lower-cased; numbers, names and units carry a mark, their type and their value.

    A word with a digit is a number (marks of thousands and decimals are left
    out of it); a capitalised word that doesn't begin a line, sentence or quote
    is a name; a unit's word after a number is a unit."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"(\p{Lu}(?<=[\pL\pN,;:)][\x20\x09]\p{Lu})\p{Ll})", _MARK + "p$1")
    t = F.lower(t)
    numbers = F.regexp_replace(F.regexp_replace(t, r"(?<=[0-9])[.,](?=[0-9])", ""), _MARK + r"?p?(?<![\pL\pN])([\pL\pN]*[0-9][\pL\pN]*)", _MARK + "n$1")
    units = F.regexp_replace(numbers, rf"({_MARK}n[\pL\pN]*[\x20\x09]+)({'|'.join(UNITS)})(?![\pL\pN])", "$1" + _MARK + "u$2")
    return F.filter(F.split(F.when(F.regexp_like(t, F.lit("[0-9]")), units).otherwise(t), _BREAKS), lambda w: w != "")


def canonical(word: Column) -> Column:
    """A word of a template: placeholders without their value."""
    return F.when(F.startswith(word, F.lit(_MARK)), F.substring(word, 1, 2)).otherwise(word)


def plain(word: Column) -> Column:
    """A word of a template with names as the words that they are."""
    return F.when(F.startswith(word, F.lit(_MARK + "p")), F.substr(word, F.lit(3))).otherwise(canonical(word))


def _windows(df: DataFrame, keep: list[str], sizes: list[int]) -> DataFrame:
    """One row for each template window: `keep`, its hash `h`, and what `_placed` needs.

    Texts are cut into overlapping pieces of PIECE window starts first, so that
    what one row explodes into is bounded however long a text is."""
    n = F.size("w")
    pieces = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(PIECE)), lambda o: F.struct(o.alias("off"), F.slice("w", o + 1, PIECE + WINDOW - 1).alias("w")))
    df = df.withColumn("pieces", pieces).select(*keep, F.explode_outer("pieces").alias("piece")).select(*keep, "piece.off", "piece.w")

    def of_size(hashed: Column, k: int) -> Column:
        hashes = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.slice(hashed, i, k)))
        return F.when(n >= k, hashes).otherwise(F.array().cast("array<bigint>"))

    # the word hashes are bound to a lambda's variable: as a column they would be put in where they are used, and so made anew for each window
    hashed = F.transform("w", lambda w: F.xxhash64(canonical(w)))
    all_sizes = lambda h: F.transform(F.array(h), lambda hw: F.concat(*[of_size(hw, k) for k in sizes]))
    # where a piece has names, its windows come a second time with the names as words
    names = F.when(F.exists("w", lambda w: F.startswith(w, F.lit(_MARK + "p"))), all_sizes(F.transform("w", lambda w: F.xxhash64(plain(w))))).otherwise(F.array(F.array().cast("array<bigint>")))
    bound = F.array(F.flatten(F.concat(all_sizes(hashed), names)))
    df = df.select(*keep, "off", "w", F.get(bound, F.lit(0)).alias("hs"))
    # the outer form: before the inner one Spark puts a filter on the array's size, for which it would build the array twice
    return df.select(*keep, "off", "w", F.posexplode_outer("hs").alias("place", "h")).where("h is not null")


def _placed(df: DataFrame, sizes: list[int], size_name: str, at_name: str, words_name: str) -> DataFrame:
    """Replaces off, w and place by a window's size, its place in the text (from 0) and its words."""
    before, size, at = F.lit(0), F.lit(None).cast("int"), F.lit(None).cast("int")
    for k in sizes * 2:  # names as placeholders, then as words; the place in the joined array tells the size and the place in the piece
        count = F.greatest(F.size("w") - k + 1, F.lit(0))
        here = size.isNull() & (F.col("place") < before + count)
        size, at, before = F.when(here, k).otherwise(size), F.when(here, F.col("place") - before).otherwise(at), before + count
    rest = [c for c in df.columns if c not in ("off", "w", "place")]
    return df.select(*rest, size.alias(size_name), (F.col("off") + at).alias(at_name), F.slice("w", at + 1, size).alias(words_name))


def contaminated(docs: DataFrame, id_col: str, text_col: str, benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """(doc_id, item_id, covered, item_words, run, windows, changed): documents that hold benchmark items.

    Texts become templates: numbers, names and units are typed placeholders. All
    windows of WINDOW template words of every whole document are joined by hash
    with the items' windows and compared word by word. On each diagonal (place in
    the document minus place in the item) changed values must map consistently:
    one value of the item to one value of the document wherever it recurs.
    Windows with a changed value count unless a value of theirs is mapped to two
    on the diagonal; windows that keep the item's values, or have no slot, always
    count. A document holds an item if the windows that count cover COVER of its
    words, or on one diagonal RUN words in a row; `changed` tells that some value
    differs in them, so the item was re-parameterised. Windows with names are also
    compared with the names as plain lower-cased words, on both sides, so copies
    in lower case or capitals, or wrapped before a name, are found; where such a
    copy has another name, windows with that name aren't.

    Items of SHORTEST to WINDOW - 1 words are one window; shorter ones, and
    windows of mostly placeholders, match nothing. Null and empty texts hold
    nothing and are held by nothing; rows with a null id are compared and
    returned with a null id; repeated documents or items give repeated pairs;
    an empty table gives an empty result; other columns are ignored. Documents'
    windows are probed where they are read when the benchmark has at most
    BROADCAST_WINDOWS windows, and are shuffled by hash with it beyond that."""
    items = benchmark.select(F.col(item_col).alias("item_id"), template_words(F.col(item_text_col)).alias("w")).withColumn("item", F.monotonically_increasing_id())
    items = items.withColumn("item_words", F.size("w")).where(F.col("item_words") >= SHORTEST)
    short = [r.item_words for r in items.where(F.col("item_words") < WINDOW).select("item_words").distinct().collect()]  # WINDOW - SHORTEST rows at most
    sizes = [WINDOW, *sorted(short)]
    ours = _placed(_windows(items, ["item", "item_id", "item_words"], sizes), sizes, "size", "ipos", "iw")
    ours = ours.where(F.col("size") == F.least(F.col("item_words"), F.lit(WINDOW))).distinct()
    # windows with names come twice from `_windows`; which hash is which is made anew here
    as_words = F.transform("iw", lambda w: F.when(F.startswith(w, F.lit(_MARK + "p")), plain(w)).otherwise(w))
    ours = ours.drop("h").distinct().withColumn("iw", F.explode(F.array_distinct(F.array("iw", as_words)))).withColumn("h", F.xxhash64(F.transform("iw", lambda w: F.xxhash64(canonical(w)))))
    # an item's first word may be taken for a name where the item stands inside a sentence
    lead = ours.where((F.col("ipos") == 0) & ~F.startswith(F.get("iw", F.lit(0)), F.lit(_MARK))).withColumn("iw", F.concat(F.array(F.concat(F.lit(_MARK + "p"), F.get("iw", F.lit(0)))), F.slice("iw", 2, WINDOW)))
    ours = ours.union(lead.withColumn("h", F.xxhash64(F.transform("iw", lambda w: F.xxhash64(canonical(w))))))
    literal = F.size(F.filter("iw", lambda w: ~F.startswith(w, F.lit(_MARK))))
    ours = ours.where(literal >= F.ceil(F.col("size") * LITERAL))

    d = docs.select(F.col(id_col).alias("doc_id"), template_words(F.col(text_col)).alias("w")).withColumn("row", F.monotonically_increasing_id())
    theirs = _windows(d, ["row", "doc_id"], sizes)
    if ours.count() <= BROADCAST_WINDOWS:
        hit = _placed(theirs.join(F.broadcast(ours), "h"), sizes, "dsize", "at", "dw")
    else:
        hit = _placed(theirs, sizes, "dsize", "at", "dw").join(ours, "h")
    # compared word by word; as a filter this would go into the join and keep it from being compiled with the scan
    equal = lambda form: F.forall(F.zip_with("iw", "dw", lambda a, b: form(a) == form(b)), lambda x: x)
    same = (F.col("size") == F.col("dsize")) & (equal(canonical) | equal(plain))
    # a name that only one side shows as one is the same word on both
    slots = F.filter(F.zip_with("iw", "dw", lambda a, b: F.struct(a.alias("i"), F.when(plain(a) == b, a).otherwise(b).alias("d"))), lambda s: F.startswith(s["i"], F.lit(_MARK)))
    hit = hit.select("row", "doc_id", "item", "item_id", "item_words", "size", (F.col("at") - F.col("ipos")).alias("diag"), F.when(same, F.struct("ipos", slots.alias("slots"))).alias("window"))

    pair = ["row", "doc_id", "item", "item_id", "item_words", "size"]
    # sets per diagonal are no longer than the item
    diag = hit.groupBy(*pair, "diag").agg(F.collect_set("window").alias("ws"))
    diag = diag.withColumn("values", F.transform(F.array_distinct(F.flatten(F.transform("ws", lambda w: w["slots"]))), lambda s: s["i"]))
    twice = F.filter(F.array_distinct("values"), lambda i: F.size(F.filter("values", lambda x: x == i)) > 1)
    diag = diag.withColumn("clash", F.when(F.size("values") != F.size(F.array_distinct("values")), twice).otherwise(F.array().cast("array<string>")))
    kept = lambda w: F.forall(w["slots"], lambda s: s["i"] == s["d"]) | ~F.exists(w["slots"], lambda s: F.array_contains("clash", s["i"]))
    diag = diag.withColumn("ws", F.filter("ws", kept)).withColumn("places", F.array_sort(F.array_distinct(F.transform("ws", lambda w: w["ipos"]))))
    # runs of overlapping windows: (end of the run so far, its start, longest)
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).alias("first"), F.lit(0).alias("longest"))

    def grow(s: Column, p: Column) -> Column:
        first = F.when(p <= s["end"], s["first"]).otherwise(p)
        return F.struct((p + F.col("size")).alias("end"), first.alias("first"), F.greatest(s["longest"], p + F.col("size") - first).alias("longest"))

    diag = diag.withColumn("run", F.aggregate("places", start, grow, lambda s: s["longest"]))
    diag = diag.withColumn("changed", F.exists("ws", lambda w: F.exists(w["slots"], lambda s: s["i"] != s["d"])))
    # a set of places is no longer than the item, however often a text repeats it
    whole = diag.select(*pair, "run", "changed", F.explode("places").alias("p")).groupBy(*pair).agg(F.array_sort(F.collect_set("p")).alias("places"), F.max("run").alias("run"), F.max("changed").alias("changed"))
    empty = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
    covered = F.aggregate("places", empty, lambda s, p: F.struct((p + F.col("size")).alias("end"), (s["sum"] + p + F.col("size") - F.greatest(p, s["end"])).alias("sum")), lambda s: s["sum"])
    out = whole.withColumn("covered", covered).where((F.col("covered") >= F.col("item_words") * COVER) | (F.col("run") >= RUN))
    return out.select("doc_id", "item_id", "covered", "item_words", "run", F.size("places").alias("windows"), "changed")


def drop_contaminated(docs: DataFrame, id_col: str, text_col: str, benchmark: DataFrame, item_col: str, item_text_col: str) -> DataFrame:
    """Rows of `docs` that hold no benchmark item, with all their columns. Rows with a null id stay."""
    bad = contaminated(docs, id_col, text_col, benchmark, item_col, item_text_col).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
