"""Elements, text and attributes of HTML by selector, in column expressions.

A page is split into tags and text, and one ``aggregate`` over its tags keeps the
stack of open elements and notes where those begin and end whose start tag some
step of some selector of the page's rule matches (one pattern for all steps). All
selectors of the rule are then answered from these spans, without another walk.

An end tag closes its element and what was left open inside it, and is ignored if
no such element is open. ``p``, ``li`` and the like are closed by the next one of
their kind.

A selector is a column (a rule's value) of steps separated by spaces, each
``tag``, ``tag.class.class``, ``[attr]`` or ``[attr=value]`` or a mix of these; a
step searches inside what the step before it found. A step may go on with
``:text(words)``: the element's text is just that; ``:first``: only the first match;
``:up(n)``: not the match itself, but its n-th ancestor. Comments, scripts and styles
are no content. Elements are outer HTML; of nested matches the outermost counts.
A null or empty selector, or a null page, finds nothing.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

# Elements without content, elements that a start tag of their own
# kind closes, and end tags that close them as well.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
SELF_CLOSING = ("p", "li", "dt", "dd", "option", "tr", "td", "th")
CONTAINERS = ("article", "blockquote", "body", "div", "dl", "html", "main", "ol", "section", "select", "table", "td", "ul")

_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_TOKEN = r"<[A-Za-z/!][^>]*>|[^<]+|<"
def _bind(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.transform(F.array(value), fn)[0]


def _pattern(step: Column) -> Column:
    """Regular expression of the start tags that one selector step matches."""
    bare = F.regexp_replace(step, r"\[[^\]]*\]", "")
    tag = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9]*)", 1)
    classes = F.transform(F.regexp_extract_all(bare, F.lit(r"\.([^.\s]+)"), 1), lambda c: F.concat(
        F.lit(r"""(?=[^>]*\sclass\s*=\s*["']?(?:[^"'>]*\s)?\Q"""), c, F.lit(r"""\E(?=[\s"'>]))""")))
    attrs = F.transform(F.regexp_extract_all(step, F.lit(r"\[([^\]=]+)(?:=[^\]]*)?\]"), 1), lambda a: F.concat(
        F.lit(r"(?=[^>]*\s\Q"), a, F.lit(r"\E(?=[\s=/>]))")))
    values = F.transform(F.regexp_extract_all(step, F.lit(r"\[([^\]=]+=[^\]]*)\]"), 1), lambda a: F.concat(
        F.lit(r"(?=[^>]*\s\Q"), F.substring_index(a, "=", 1), F.lit(r"""\E\s*=\s*["']?\Q"""),
        F.btrim(F.substring(a, F.instr(a, "=") + 1, F.length(a)), F.lit("\"'")), F.lit(r"""\E["'\s/>])""")))
    name = F.when(tag == "", F.lit("[A-Za-z][A-Za-z0-9]*")).otherwise(tag)
    return F.concat(F.lit("(?is)^<"), name, F.lit(r"(?=[\s/>])"), F.array_join(classes, ""), F.array_join(attrs, ""),
                    F.array_join(values, ""))


_SPANS = "array<struct<start:int,end:int>>"
_STEPS = "array<struct<pattern:string,text:string,up:int,first:boolean>>"
_OPEN = "array<struct<name:string,start:int,keep:boolean,box:boolean>>"
_NEVER = "(?!)"


def _col(c) -> Column:
    return F.lit(c) if isinstance(c, str) else c


def compiled(selector) -> Column:
    """The steps of a selector."""
    sel = F.trim(F.coalesce(_col(selector), F.lit("")))
    steps = F.filter(F.split(sel, r"\s+(?![^\[]*\])(?![^(]*\))"), lambda s: s != "")
    return F.transform(steps, lambda s: F.struct(
        _pattern(F.regexp_replace(s, r":(?:text|up)\([^)]*\)|:first\b", "")).alias("pattern"),
        F.when(s.contains(":text("), F.regexp_extract(s, r":text\(([^)]*)\)", 1)).alias("text"),
        F.coalesce(F.regexp_extract(s, r":up\(([0-9]{1,4})\)", 1).try_cast("int"), F.lit(0)).alias("up"),
        s.rlike(r":first\b").alias("first"))).cast(_STEPS)


def _any(steps: Column) -> Column:
    """One pattern for all of some steps."""
    return F.when(F.size(steps) > 0, F.array_join(F.transform(steps, lambda s: s["pattern"]), "|")).otherwise(F.lit(_NEVER))


def patterns(steps: Column) -> Column:
    """What a walk has to note for these steps: start tags that match one, and
    start tags whose ancestors are asked for."""
    return F.struct(_any(steps).alias("hit"), _any(F.filter(steps, lambda s: s["up"] > 0)).alias("climb"))


def _marks(tokens: Column, wanted: Column) -> Column:
    """What the walk needs of each tag: its place and name, whether it closes, has
    no content, closes its own kind, bounds such closing, and matches."""
    name = lambda t: F.lower(F.regexp_extract(t, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
    tags = F.filter(F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.alias("i"), name(t).alias("name"))),
                    lambda x: x["name"] != "")
    return F.transform(tags, lambda x: F.struct(
        x["i"].alias("i"), x["name"].alias("name"), x["t"].startswith("</").alias("close"),
        (x["name"].isin(*VOID) | x["t"].endswith("/>")).alias("void"), x["name"].isin(*SELF_CLOSING).alias("auto"),
        x["name"].isin(*CONTAINERS).alias("box"), F.rlike(x["t"], wanted["hit"]).alias("hit"),
        F.when(wanted["climb"] != _NEVER, F.rlike(x["t"], wanted["climb"])).otherwise(F.lit(False)).alias("climb")))


def _last(stack: Column, test) -> Column:
    """Place (from 1) of the last open element that passes, 0 if none does."""
    at = F.array_position(F.reverse(F.transform(stack, test)), True)
    return F.when(at > 0, F.size(stack) + 1 - at).otherwise(0).cast("int")


def _spans(tokens: Column, wanted: Column) -> Column:
    """(start, end) of the noted elements in order: ``tokens[start:end]``."""
    begin = F.struct(F.array().cast(_OPEN).alias("open"), F.array().cast(_SPANS).alias("found"))
    ended = lambda entries, end: F.transform(F.filter(entries, lambda e: e["keep"]), lambda e: F.struct(
        e["start"].alias("start"), end(e).alias("end"))).cast(_SPANS)

    def walk(s: Column, x: Column) -> Column:
        stack = s["open"]
        same = _last(stack, lambda e: e["name"] == x["name"])
        closes = F.when(x["close"], same).when(x["auto"], F.when(same > _last(
            stack, lambda e: e["box"] & (e["name"] != x["name"])), same).otherwise(0)).otherwise(0)

        def from_(cut: Column) -> Column:
            done = F.when(cut > 0, ended(F.slice(stack, cut, F.size(stack)), lambda e: x["i"] + F.when(
                x["close"] & (e["start"] == stack[cut - 1]["start"]), 1).otherwise(0))).otherwise(F.array().cast(_SPANS))
            left = F.when(cut > 0, F.slice(stack, F.lit(1), cut - 1)).otherwise(stack)
            left = F.when(x["climb"], F.transform(left, lambda e: F.struct(
                e["name"].alias("name"), e["start"].alias("start"), F.lit(True).alias("keep"), e["box"].alias("box"))).cast(_OPEN)).otherwise(left)
            own = F.array(F.struct(x["name"].alias("name"), x["i"].alias("start"), x["hit"].alias("keep"), x["box"].alias("box"))).cast(_OPEN)
            alone = F.when(~x["close"] & x["void"] & x["hit"], F.array(F.struct(
                x["i"].alias("start"), (x["i"] + 1).alias("end"))).cast(_SPANS)).otherwise(F.array().cast(_SPANS))
            return F.struct(F.when(x["close"] | x["void"], left).otherwise(F.concat(left, own)).alias("open"),
                            F.concat(s["found"], done, alone).alias("found"))

        return _bind(closes, from_)

    return F.aggregate(_marks(tokens, wanted), begin, walk, lambda s: F.array_sort(
        F.concat(s["found"], ended(s["open"], lambda e: F.size(tokens)))))


def tree(fragment: Column, wanted: Column) -> Column:
    """Tokens of a fragment and the spans that ``wanted`` (``patterns``) asks for."""
    return _bind(F.regexp_extract_all(fragment, F.lit(_TOKEN), 0), lambda t: F.struct(
        t.alias("tokens"), _spans(t, wanted).alias("found")))


def whole(t: Column) -> Column:
    return F.struct(F.lit(0).alias("start"), F.size(t["tokens"]).alias("end"))


def outer(t: Column, span: Column, drop: Column | None = None) -> Column:
    """Outer HTML of a span, without the spans of ``drop``."""
    part = F.slice(t["tokens"], span["start"] + 1, span["end"] - span["start"])
    if drop is not None:
        part = F.filter(part, lambda _, i: ~F.exists(drop, lambda d: (d["start"] <= span["start"] + i) & (span["start"] + i < d["end"])))
    return F.array_join(part, "")


def find(t: Column, steps: Column, scope: Column) -> Column:
    """Spans that the steps find inside a span."""
    within = lambda a, b: (b["start"] < a["start"]) & (a["end"] <= b["end"])

    def step(spans: Column, s: Column) -> Column:
        hits = F.filter(t["found"], lambda f: F.exists(spans, lambda c: within(f, c)) & F.rlike(t["tokens"][f["start"]], s["pattern"])
                        & F.when(s["text"].isNull(), True).otherwise(text(outer(t, f)) == s["text"]))
        top = _bind(hits, lambda h: F.filter(h, lambda f: ~F.exists(h, lambda o: within(f, o))))
        top = _bind(top, lambda h: F.when(s["first"], F.slice(h, 1, 1)).otherwise(h))
        above = lambda f: F.try_element_at(F.filter(t["found"], lambda a: within(f, a)), -s["up"])
        return _bind(top, lambda h: F.when(s["up"] == 0, h).otherwise(F.array_distinct(
            F.filter(F.transform(h, above), lambda f: f.isNotNull()))))

    return F.when(F.size(steps) > 0, F.aggregate(steps, F.array(scope).cast(_SPANS), step)).otherwise(F.array().cast(_SPANS))


def page(html: Column) -> Column:
    """A page as a fragment to search: hidden content removed, under one root."""
    return F.concat(F.lit("<page>"), F.regexp_replace(html, _HIDDEN, ""))


def elements(fragment: Column, selector) -> Column:
    """Outer HTML of the elements of a fragment (``page`` or an element)."""
    found = _bind(compiled(selector), lambda steps: _bind(tree(fragment, patterns(steps)), lambda t: F.transform(
        find(t, steps, whole(t)), lambda f: outer(t, f))))
    return F.coalesce(found, F.array().cast("array<string>"))


def first(fragment: Column, selector) -> Column:
    """Outer HTML of the first match, null when there is none."""
    return F.try_element_at(elements(fragment, selector), F.lit(1))


def attribute(element: Column, name) -> Column:
    """An attribute of an element's own start tag, null when it has none."""
    tag = F.regexp_extract(element, r"(?s)^<[^>]*>", 0)
    pat = F.concat(F.lit(r"(?is)\s\Q"), _col(name), F.lit(r"""\E\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)"""))
    value = F.call_function("regexp_extract", tag, pat, F.lit(1))
    bare = lambda v: F.when(v.startswith('"') | v.startswith("'"), F.substring(v, F.lit(2), F.length(v) - 2)).when(
        v != "", v)
    return _bind(value, lambda v: unescape(bare(v)))


def text(element: Column) -> Column:
    """Text of an element: tags removed, entities decoded."""
    return _bind(F.regexp_replace(element, r"(?s)<[A-Za-z/!][^>]*>", ""), unescape)


def compiled_field(rule) -> Column:
    """A rule ``selector`` (text) or ``selector@attr`` (attribute), compiled; with
    an empty selector it speaks of the element itself."""
    rule = F.coalesce(_col(rule), F.lit(""))
    sel = F.trim(F.substring_index(rule, "@", 1))
    return F.struct(compiled(sel).alias("steps"), F.regexp_extract(rule, "@(.*)$", 1).alias("attr"), (rule != "").alias("given"))


def field(t: Column, span: Column, rule: Column) -> Column:
    """A compiled rule's value inside a span. An empty rule or a missing element
    gives null."""
    target = F.when(F.size(rule["steps"]) == 0, span).otherwise(F.try_element_at(find(t, rule["steps"], span), F.lit(1)))
    value = _bind(_bind(target, lambda f: F.when(f.isNotNull(), outer(t, f))),
                  lambda e: F.when(rule["attr"] != "", attribute(e, rule["attr"])).otherwise(text(e)))
    return F.when(rule["given"], value)


def meta_content(html: Column, name: str) -> Column:
    """``content`` of the first ``<meta>`` whose name, property or itemprop is
    ``name``, null when there is none."""
    tag = F.regexp_extract(html, rf"""(?is)<meta\b(?=[^>]*\s(?:name|property|itemprop)\s*=\s*["']?\Q{name}\E["'\s/>])[^>]*>""", 0)
    return F.when(tag != "", attribute(tag, "content"))


# --- entities ---------------------------------------------------------------------------

_NAMED = "\x02".join(f"{k[:-1]}\x01{v}" for k, v in html5.items() if k.endswith(";"))


def unescape(c: Column) -> Column:
    """Character references decoded in one pass: every HTML name, decimal and
    hexadecimal numbers; what is none stays."""
    named = F.str_to_map(F.lit(_NAMED), F.lit("\x02"), F.lit("\x01"))   # folded to a literal once

    def decoded(part: Column, i: Column) -> Column:
        ref = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);", 1)
        number = F.when(ref.rlike("^#[xX]"), F.conv(F.substring(ref, F.lit(3), F.length(ref)), 16, 10)).when(
            ref.startswith("#"), F.substring(ref, F.lit(2), F.length(ref))).cast("long")
        legal = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        value = F.coalesce(F.when(legal, char), F.when(~ref.startswith("#") & (ref != ""), named[ref]))
        rest = F.substring(part, F.length(ref) + 2, F.length(part))
        return F.when(i == 0, part).when(value.isNotNull(), F.concat(value, rest)).otherwise(F.concat(F.lit("&"), part))

    return F.when(c.contains("&"), F.array_join(F.transform(F.split(c, "&"), decoded), "")).otherwise(c)


# --- rules ------------------------------------------------------------------------------


def extract_cards(pages: DataFrame, rules: DataFrame, on: str, html_col: str = "html") -> DataFrame:
    """One row per listing card. ``rules(on, card, title, link, date)`` holds each
    source's selectors; a page without a rule has no cards."""
    keep, fields = [c for c in pages.columns if c != html_col], ("title", "link", "date")
    # compiled once a rule
    r = rules.select(on, compiled(F.col("card")).alias("_card"), *[compiled_field(F.col(c)).alias(f"_{c}") for c in fields])
    r = r.withColumn("_wanted", patterns(F.concat("_card", *[F.col(f"_{c}.steps") for c in fields])))
    cards = _bind(tree(page(F.col(html_col)), F.col("_wanted")), lambda t: F.transform(
        find(t, F.col("_card"), whole(t)), lambda c: F.struct(*[field(t, c, F.col(f"_{f}")).alias(f) for f in fields])))
    return (pages.join(r, on, "left").select(*keep, F.posexplode(cards).alias("pos", "_card"))
            .select(*keep, F.col("pos").cast("long").alias("pos"), *[F.col(f"_card.{f}").alias(f) for f in fields]))


#: How the text of a container is taken.
WHOLE, JOINED, LEADING = "text", "paragraphs", "first"


def extract_container(pages: DataFrame, rules: DataFrame, on: str, html_col: str = "html",
                      out_col: str = "text") -> DataFrame:
    """Article text per page. ``rules(on, container, drop[, take])``: the first
    match of ``container`` without the elements inside it that any of the
    comma-separated selectors of ``drop`` finds; ``take`` is its whole text (by
    default), its paragraphs each followed by a line feed, or the first
    paragraph. A page without a rule or a match has an empty text."""
    keep = [c for c in pages.columns if c != html_col]
    take = F.col("take") if "take" in rules.columns else F.lit(WHOLE)
    drops = F.transform(F.split(F.coalesce("drop", F.lit("")), r",(?![^(]*\))"), compiled)
    r = rules.select(on, compiled(F.col("container")).alias("_container"), drops.alias("_drop"), compiled("p").alias("_p"),
                     F.coalesce(take, F.lit(WHOLE)).alias("_take"))
    r = r.withColumn("_wanted", patterns(F.concat("_container", F.flatten("_drop"), F.when(
        F.col("_take") == WHOLE, F.array().cast(_STEPS)).otherwise(F.col("_p")))))

    def taken(t: Column, body: Column) -> Column:
        gone = F.flatten(F.transform("_drop", lambda steps: find(t, steps, body)))
        inside = lambda f, d: (d["start"] <= f["start"]) & (f["end"] <= d["end"])
        return _bind(gone, lambda d: F.when(F.col("_take") == WHOLE, text(outer(t, body, d))).otherwise(_bind(
            F.transform(F.filter(find(t, F.col("_p"), body), lambda f: ~F.exists(d, lambda x: inside(f, x))),
                        lambda f: text(outer(t, f, d))),
            lambda ps: F.when(F.col("_take") == LEADING, F.try_element_at(ps, F.lit(1))).otherwise(
                F.array_join(F.transform(ps, lambda p: F.concat(p, F.lit("\n"))), "")))))

    value = _bind(tree(page(F.col(html_col)), F.col("_wanted")), lambda t: _bind(
        F.try_element_at(find(t, F.col("_container"), whole(t)), F.lit(1)),
        lambda body: F.when(body.isNotNull(), taken(t, body))))
    return pages.join(r, on, "left").select(*keep, F.coalesce(value, F.lit("")).alias(out_col))
