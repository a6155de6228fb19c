"""Main text of web pages by deducing each host's template.

A page is a sequence of tokens: tags and runs of text, each told apart by the path of
elements that it stands in. Tokens of a host that occur equally often on every page of it
(equal occurrence vectors) form an equivalence class; vectors are compared by a 64-bit
sum over the pages, so a host of any number of pages is a plain aggregate. Classes of
tokens that stand in one order on every page, and inside one gap of another class on all
of them, are valid: nested, they are the host's template. What stands between two
neighbouring tokens of a class is a slot. A slot holds main text if its pages put it into
an article; on hosts without such elements, if it isn't boilerplate by its elements, nor
mostly links, nor a small fraction of the longest slot. Text that is itself a token of the
template is a label, not content.

A template is one row a host: only tokens on half of its pages or more are looked at, so
it has at most twice as many tokens as the host's mean page. Templates meet pages by the
host; Spark broadcasts them while their files are small, and else joins by sorting,
where AQE splits a host of very many pages.

Elements whose name, role, class or id says menu, header, footer, sidebar, notice, advert,
form or comment are dropped inside articles too. ``header`` counts as the article's own
inside an article.

Defined cases: null or empty html gives an empty text; a url that is null or has no host
belongs to the host ''; a host of fewer than ``MIN_PAGES`` different pages has no template
and its pages are judged by their own elements; pages that repeat count once for the
template and are each returned; unclosed and stray tags close as browsers do; an empty
table gives no rows; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import arrow_rows, ascii_lower, stage

MIN_PAGES = 3           # different pages of a host that make a template
MIN_LABEL_PAGES = 8     # different pages that make a repeated text a label
PAGE_ROWS = 500         # whole pages in a batch
KNOWN_HOSTS = 200       # templates that a task keeps

# ---- fixed values of HTML -------------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div
dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li
main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead title
tr ul""".split())
CLOSES_P = BLOCK - frozenset("body caption dd dt head html legend li optgroup option tbody td "
                             "tfoot th thead title tr".split())
# elements that end an open one of the same kind, unless one of the others lies between
SIBLINGS = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dd": (("dd", "dt"), ("dl",)),
            "dt": (("dd", "dt"), ("dl",)), "tr": (("tr",), ("table",)),
            "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
            "option": (("option",), ("select", "datalist"))}
P_SCOPE = ("table", "td", "th", "caption", "button", "object", "template")

BOILER_TAGS = frozenset("""nav footer aside form script style noscript template iframe svg button
select datalist option textarea label dialog menu object canvas audio video head title noembed
noframes search""".split())
BOILER_ROLES = frozenset("""navigation banner contentinfo complementary search dialog alert
alertdialog menu menubar toolbar form status""".split())
BOILER_NAMES = frozenset("""nav navbar navigation menu footer sidebar aside ad ads adv advert advertisement
adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay
newsletter subscribe subscription comment comments commentlist disqus respond reply replies share
sharing social breadcrumb breadcrumbs related recommended recommendations pagination pager toolbar
login signup search masthead topbar""".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = frozenset("article post entry content story main body maincontent articlebody".split())

# flags of a place in a page
BOILER, ARTICLE, NAMED, LINK, HEADING = 1, 2, 4, 8, 16

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|"
                  r"<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>", re.S)
_CUT = re.compile(r"</?[a-zA-Z]|<!--")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")


def _key(*parts) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts))) - (1 << 63)


def _describe(name: str, attributes: str) -> tuple[int, str]:
    """(flags, spelling) of a start tag; digits don't tell elements apart."""
    flags = BOILER if name in BOILER_TAGS else ARTICLE if name in MAIN_TAGS else 0
    if name == "a":
        flags |= LINK
    elif name == "h1":
        flags |= HEADING
    spelt = name
    if attributes.strip(" /"):
        found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTRIBUTE.findall(attributes)}
        names = {w.lower() for a in ("class", "id") for w in _NAME.findall(found.get(a, ""))}
        style = found.get("style", "").replace(" ", "").lower()
        if ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
                or "display:none" in style or "visibility:hidden" in style
                or found.get("role", "").lower() in BOILER_ROLES):
            flags |= BOILER
        if name not in ("html", "body", "main"):
            if names & MAIN_NAMES and not names & {"comment", "comments"}:
                flags |= NAMED
            elif names & (BOILER_NAMES if name != "article" else {"comment", "comments"}):
                flags |= BOILER
        if found.get("role", "").lower() in MAIN_TAGS or found.get("itemprop") == "articleBody":
            flags |= ARTICLE
        spelt = _DIGITS.sub("", f"{name}.{found.get('class', '')}#{found.get('id', '')}")
    return flags, spelt


class Page:
    """A page's tokens: ``keys``, with ``flags`` of the place, ``words`` of a run of text
    (0 for tags), and for runs ``texts`` and the number of the block they belong to."""

    _known: dict[tuple[str, str], tuple[int, str]] = {}
    _places: dict[tuple[int, str], int] = {}        # keys of tags, by path

    def __init__(self, source: str):
        self.keys: list[int] = []
        self.flags: list[int] = []
        self.words: list[int] = []
        self.texts: list[str | None] = []
        self.blocks: list[int] = []
        self.block = 0
        # open elements: name, path, flags; and the places of each name among them
        self.stack: list[tuple[str, int, int]] = [("", 0, 0)]
        self.open: dict[str, list[int]] = {}
        self.last_block = [0]
        self._read(source)

    def _add(self, key: int, flags: int, text: str | None = None, words: int = 0) -> None:
        self.keys.append(key)
        self.flags.append(flags)
        self.words.append(words)
        self.texts.append(text)
        self.blocks.append(self.block)

    def _place(self, path: int, name: str) -> int:
        key = self._places.get((path, name))
        if key is None:
            if len(self._places) > 50_000:
                self._places.clear()
            key = self._places[path, name] = _key(path, name)
        return key

    def _text(self, raw: str) -> None:
        if not raw:
            return
        text = entities.unescape(raw) if "&" in raw else raw
        _, path, flags = self.stack[-1]
        words = text.split()
        if not words:           # parts words, but is no token
            if self.texts and self.blocks[-1] == self.block and self.texts[-1] is not None:
                self.texts[-1] += " "
            else:
                self._space()
            return
        self._add(_key(path, "text", " ".join(words)), flags, text, len(words))

    def _space(self) -> None:
        """White space between tags of one block."""
        if self.texts and self.blocks[-1] == self.block:
            self.texts[-1] = (self.texts[-1] or "") + " "

    def _read(self, source: str) -> None:
        end = source.rfind(">") + 1
        at = 0
        while at < end:
            m = _TAG.search(source, at, end)
            if m is None:
                break
            self._text(source[at:m.start()])
            at = m.end()
            name = (m[2] or "").lower()
            if not name:
                continue
            if m[1]:
                self._end(name)
                continue
            self._start(name, m[3] or "")
            if name in RAW:
                close = re.compile(f"</{name}(?=[\\s/>])", re.I).search(source, at)
                at = len(source) if close is None else close.start()
        cut = _CUT.search(source, at)       # a tag that the page ends in
        self._text(source[at:] if cut is None else source[at:cut.start()])

    def _top(self, names) -> int:
        return max((self.open[n][-1] for n in names if self.open.get(n)), default=0)

    def _pop_to(self, place: int) -> None:
        while len(self.stack) > place:
            name, path, flags = self.stack.pop()
            self.open[name].pop()
            if name in BLOCK:
                self.block += 1
                self.last_block.pop()

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self._space()
        if name in CLOSES_P:
            p = self._top(("p",))
            if p > self._top(P_SCOPE):
                self._pop_to(p)
        if name in SIBLINGS:
            same, between = SIBLINGS[name]
            old = self._top(same)
            if old > self._top(between):
                self._pop_to(old)
        known = self._known.get((name, attributes))
        if known is None:
            known = _describe(name, attributes)
            if len(self._known) > 20_000:
                self._known.clear()
            self._known[name, attributes] = known
        own, spelt = known
        _, path, inside = self.stack[-1]
        if name == "header" and not inside & ARTICLE:
            own |= BOILER
        if name in BLOCK:
            self.block += 1
        place = self._place(path, spelt)
        self._add(place, inside | own)
        if name not in VOID:
            self.open.setdefault(name, []).append(len(self.stack))
            self.stack.append((name, place, inside | own))
            if name in BLOCK:
                self.last_block.append(len(self.stack) - 1)

    def _end(self, name: str) -> None:
        if name == "br":
            return self._space()
        at = self.open.get(name)
        if not at:
            if name in BLOCK:
                self.block += 1
            return None
        if name not in BLOCK and at[-1] < self.last_block[-1]:
            return None         # an inline element doesn't close the block inside it
        _, path, flags = self.stack[at[-1]]
        self._pop_to(at[-1])
        self._add(self._place(path, "/"), flags)
        return None


# ---- templates ---------------------------------------------------------------

class Template:
    """Valid classes of a host: for every token its class and place in it."""

    def __init__(self, rows):
        self.place = {r["token"]: (r["class"], r["place"]) for r in rows}
        self.size: dict[int, int] = {}
        self.names: dict[tuple[int, int], int] = {}
        for group, _ in self.place.values():
            self.size[group] = self.size.get(group, 0) + 1

    def slots(self, keys: list[int]) -> list[int | None]:
        """The innermost slot around each token; None outside the template."""
        out, stack, here = [], [], None
        for key in keys:
            found = self.place.get(key)
            if found is not None:
                group, place = found
                while place and stack and stack[-1][0] != group:
                    stack.pop()
                if place and stack:
                    stack.pop()
                if place < self.size[group] - 1:
                    stack.append((group, place))
                here = self._slot(stack[-1]) if stack else None
            out.append(here)
        return out

    def _slot(self, gap: tuple[int, int]) -> int:
        if gap not in self.names:
            self.names[gap] = _key(*gap)
        return self.names[gap]


def _orders(keys: list[int], group_of: dict[int, int]) -> dict[int, tuple[bool, int, int]]:
    """Per class on one page: (its tokens repeat in one order, that order, the gap of the
    nearest class around all of them)."""
    seen: dict[int, list[tuple[int, int]]] = {}
    for i, key in enumerate(keys):
        group = group_of.get(key)
        if group is not None:
            seen.setdefault(group, []).append((i, key))
    spans, out = {}, {}
    for group, found in seen.items():
        order = [k for _, k in found]
        size = len(set(order))
        regular = all(order[i] == order[i % size] for i in range(len(order)))
        out[group] = regular, _key(*order[:size])
        spans[group] = [i for i, _ in found], size
    for group, (places, _) in spans.items():
        first, last, around = places[0], places[-1], (None, 0, 0)
        for other, (outer, size) in spans.items():
            if other == group or not out[other][0] or not outer[0] < first:
                continue
            before = sum(p < first for p in outer)
            inside = before % size != 0 and before < len(outer) and outer[before] > last
            if inside and (around[0] is None or outer[before] - outer[before - 1] < around[0]):
                around = outer[before] - outer[before - 1], other, before % size
        out[group] = *out[group], _key(around[1], around[2])
    return out


def host_of(url: Column) -> Column:
    """The hash of what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the
    end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.xxhash64(ascii_lower(rest))


_READ = "host long, page long, keys array<long>, flags array<int>, words array<int>"


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, source in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
            page = Page(source)
            rows.append((host, xxhash.xxh64_intdigest(source.encode()) - (1 << 63),
                         page.keys, page.flags, page.words))
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("host", "page", "keys", "flags", "words"),
                (pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()),
                    pa.list_(pa.int32())))))))


def _once(read: DataFrame) -> DataFrame:
    """``read`` without pages that repeat an equal one of their host. Only the keys are
    shuffled; the repeats' list meets the pages by a broadcast while its files are small."""
    rows = stage(read.withColumn("row", F.monotonically_increasing_id()), "pages-read")
    again = stage(rows.groupBy("host", "page").agg(F.min("row").alias("first"),
                                                   F.count(F.lit(1)).alias("n"))
                  .where("n > 1").drop("n"), "pages-again")
    return (rows.join(again, ["host", "page"], "left")
            .where("first IS NULL OR row = first").drop("first", "row"))


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every other."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _times(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per page and token: what the page adds to the token's vector, which is a
    hash of the page and of how often the token occurs there."""
    for batch in batches:
        hosts, tokens, vectors = [], [], []
        for host, page, keys in zip(*(batch.column(c) for c in ("host", "page", "keys"))):
            found, n = np.unique(keys.values.to_numpy(), return_counts=True)
            own = np.uint64(page.as_py() % (1 << 64))
            hosts += [host.as_py()] * len(found)
            tokens.append(found)
            vectors.append(_mix(_mix(n.astype(np.uint64)) ^ own).view(np.int64))
        if hosts:
            yield pa.RecordBatch.from_pydict({
                "host": pa.array(hosts, pa.int64()), "token": pa.array(np.concatenate(tokens)),
                "vector": pa.array(np.concatenate(vectors))})


def equivalence_classes(read: DataFrame) -> DataFrame:
    """(host, token, class, pages, of): tokens on half of a host's different pages or
    more, with equal classes for equal occurrence vectors. ``read``: host, page, keys,
    a row per different page."""
    vectors = (read.select("host", "page", "keys")
               .mapInArrow(_times, "host long, token long, vector long")
               .groupBy("host", "token")
               .agg(F.count(F.lit(1)).alias("pages"), F.bit_xor("vector").alias("vector")))
    sizes = read.groupBy("host").agg(F.count(F.lit(1)).alias("of")).where(F.col("of") >= MIN_PAGES)
    return (vectors.join(sizes, "host").where("pages * 2 >= of")
            .select("host", "token", F.xxhash64("vector", "pages").alias("class"), "pages", "of"))


def _by_host(batch: pa.RecordBatch, make, known: dict) -> Iterator[tuple]:
    """(host, what ``make`` gives of its template's tokens, row number): rows of one host
    come with the same tokens, which are read once."""
    tokens = batch.column("tokens")
    for i, host in enumerate(batch.column("host").to_pylist()):
        if host not in known:
            if len(known) >= KNOWN_HOSTS:
                known.clear()
            known[host] = make(tokens[i].as_py())
        yield host, known[host], i


def _groups(tokens: list[dict]) -> dict[int, int]:
    return {t["token"]: t["class"] for t in tokens}


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        out = []
        keys = batch.column("keys")
        for host, group_of, i in _by_host(batch, _groups, known):
            for group, (regular, order, around) in _orders(keys[i].as_py(), group_of).items():
                out.append((host, group, regular, order, around))
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("host", "class", "regular", "order", "around"),
                (pa.array(c, t) for c, t in zip(zip(*out), (
                    pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()))))))


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of every token in its class, which is the same on all pages that have the
    class: a batch tells it once."""
    known: dict = {}
    for batch in batches:
        out: dict[tuple[int, int], tuple] = {}
        keys = batch.column("keys")
        seen: set[tuple[int, int]] = set()
        for host, group_of, i in _by_host(batch, _groups, known):
            next_place: dict[int, int] = {}
            own = [k for k in keys[i].as_py() if k in group_of]
            for key in dict.fromkeys(own):
                group = group_of[key]
                if (host, group) not in seen:
                    place = next_place[group] = next_place.get(group, -1) + 1
                    out[host, key] = host, key, group, place
            seen.update((host, group) for group in next_place)
        if out:
            yield pa.RecordBatch.from_pydict(dict(zip(
                ("host", "token", "class", "place"),
                (pa.array(c, t) for c, t in zip(zip(*out.values()), (
                    pa.int64(), pa.int64(), pa.int64(), pa.int32()))))))


def valid_classes(read: DataFrame, classes: DataFrame) -> DataFrame:
    """(host, token, class, place) of the ordered and nested classes of two tokens and
    more; ``place`` is the token's place in its class's order."""
    by_host = stage(classes.groupBy("host").agg(
        F.collect_list(F.struct("token", "class")).alias("tokens")), "classes")
    met = read.select("host", "page", "keys").join(by_host, "host")
    checked = met.drop("page").mapInArrow(
        _check, "host long, class long, regular boolean, order long, around long")
    # the order stands for all tokens, so a page with another order, or with some of the
    # tokens in another place, makes the class invalid
    valid = (checked.groupBy("host", "class")
             .agg(F.bool_and("regular").alias("regular"),
                  F.min("order").alias("o1"), F.max("order").alias("o2"),
                  F.min("around").alias("a1"), F.max("around").alias("a2"))
             .where("regular and o1 = o2 and a1 = a2").select("host", "class"))
    kept = stage(classes.join(valid, ["host", "class"], "left_semi"), "valid-classes")
    placed = (stage(kept.groupBy("host").agg(
        F.collect_list(F.struct("token", "class")).alias("tokens")), "valid-tokens")
        .join(read.select("host", "page", "keys"), "host").drop("page")
        .mapInArrow(_place, "host long, token long, class long, place int"))
    # all pages that have the class give the same places
    return (placed.groupBy("host", "token", "class").agg(F.any_value("place").alias("place"))
            .join(kept.select("host", "token", "pages", "of"), ["host", "token"]))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict = {}
    for batch in batches:
        totals: dict[tuple[int, int], list[int]] = {}
        keys, flags, words = (batch.column(c) for c in ("keys", "flags", "words"))
        for host, template, i in _by_host(batch, Template, known):
            for slot, flag, n in zip(template.slots(keys[i].as_py()), flags[i].as_py(),
                                     words[i].as_py()):
                if n and slot is not None:
                    t = totals.setdefault((host, slot), [0] * 6)
                    t[0] += n
                    if flag & BOILER:
                        t[1] += n
                    else:
                        t[2] += n * bool(flag & ARTICLE)
                        t[3] += n * bool(flag & NAMED)
                    t[4] += n * bool(flag & LINK)
                    t[5] += n * bool(flag & HEADING)
        if totals:
            out = [(*where, *t) for where, t in totals.items()]
            names = ("host", "slot", "words", "boiler", "article", "named", "link", "heading")
            yield pa.RecordBatch.from_pydict(dict(zip(names, (
                pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 8)))))


def main_slots(read: DataFrame, templates: DataFrame) -> DataFrame:
    """(host, slots): the slots that hold main text."""
    measured = (read.select("host", "keys", "flags", "words").join(templates, "host")
                .mapInArrow(_measure, "host long, slot long, words long, boiler long, "
                                      "article long, named long, link long, heading long"))
    sums = measured.groupBy("host", "slot").agg(*[
        F.sum(c).alias(c) for c in ("words", "boiler", "article", "named", "link", "heading")])
    # slots of a host are as few as its template's tokens
    host = Window.partitionBy("host")
    plain = (F.col("boiler") * 2 < F.col("words")) & (F.col("link") * 2 < F.col("words"))
    ranked = (sums.withColumn("plain", plain)
              .withColumn("articles", F.sum("article").over(host))
              .withColumn("names", F.sum(F.when(F.col("plain"), F.col("named"))).over(host))
              .withColumn("most", F.max(F.when(F.col("plain"), F.col("words"))).over(host)))
    main = (F.when(F.col("articles") > 0, F.col("article") * 2 >= F.col("words"))
            .when(~F.col("plain"), F.lit(False))
            .when(F.col("names") > 0, (F.col("named") * 2 >= F.col("words")) | (F.col("heading") > 0))
            .otherwise((F.col("words") * 10 >= F.col("most")) | (F.col("heading") > 0)))
    return ranked.where(main).groupBy("host").agg(F.collect_list("slot").alias("slots"))


def learn_templates(pages: DataFrame) -> DataFrame:
    """One row a host: its template's tokens (token, class, place, pages, of), and the
    slots that hold main text."""
    some = pages.where("html <> ''").select(host_of(F.col("url")).alias("host"), "html")
    with arrow_rows(pages.sparkSession, PAGE_ROWS):
        read = _once(some.mapInArrow(_read, _READ))
        classes = stage(equivalence_classes(read), "vectors")
        large = classes.groupBy("host", "class").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        tokens = valid_classes(read, stage(classes.join(large.drop("n"), ["host", "class"]), "classes"))
        templates = stage(tokens.groupBy("host").agg(F.collect_list(
            F.struct("token", "class", "place", "pages", "of")).alias("tokens")), "templates")
        return stage(templates.join(main_slots(read, templates), "host", "left"), "templates")


# ---- extraction --------------------------------------------------------------

def main_text(source: str, template: Template | None = None, slots: frozenset[int] = frozenset(),
              labels: frozenset[int] = frozenset()) -> str:
    """The main text of one page, blocks parted by an empty line."""
    page = Page(source)
    places = template.slots(page.keys) if template is not None and slots else [None] * len(page.keys)
    runs = [i for i, text in enumerate(page.texts) if text is not None]
    fit = [i for i in runs if page.words[i] and not page.flags[i] & BOILER
           and page.keys[i] not in labels]
    chosen = {i for i in fit if page.flags[i] & ARTICLE} or {i for i in fit if places[i] in slots}
    if not chosen:
        chosen = {i for i in fit if page.flags[i] & NAMED}
        if chosen:
            chosen |= {i for i in fit if page.flags[i] & HEADING}
    if not chosen:      # blocks that aren't mostly links
        total: dict[int, list[int]] = {}
        for i in fit:
            t = total.setdefault(page.blocks[i], [0, 0])
            t[bool(page.flags[i] & LINK)] += page.words[i]
        chosen = {i for i in fit if total[page.blocks[i]][0] >= total[page.blocks[i]][1]}
    out: dict[int, list[str]] = {}
    for i in runs:
        if i in chosen:
            out.setdefault(page.blocks[i], []).append(page.texts[i])
        elif page.blocks[i] in out and not page.words[i]:
            out[page.blocks[i]].append(" ")
    blocks = (" ".join("".join(parts).split()) for parts in out.values())
    return "\n\n".join(b for b in blocks if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[int, tuple] = {}
    for batch in batches:
        hosts, tokens, slots = (batch.column(c) for c in ("host", "tokens", "slots"))
        texts = []
        for i, source in enumerate(batch.column("html")):
            source = source.as_py()
            if not source:
                texts.append("")
                continue
            host = hosts[i].as_py()
            if host not in known:
                if len(known) >= KNOWN_HOSTS:
                    known.clear()
                rows = tokens[i].as_py()
                known[host] = () if rows is None else (
                    Template(rows), frozenset(slots[i].as_py() or ()),
                    frozenset(r["token"] for r in rows
                              if r["pages"] == r["of"] >= MIN_LABEL_PAGES))
            texts.append(main_text(source, *known[host]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()),
             pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, templates: DataFrame | None = None) -> DataFrame:
    """Per row of ``pages(page_id, url, html)``: page_id, url, text, n_chars."""
    if templates is None:
        templates = learn_templates(pages)
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    met = rows.join(templates, "host", "left")
    with arrow_rows(pages.sparkSession, PAGE_ROWS):
        return stage(met.mapInArrow(_extract, "page_id long, url string, text string, n_chars long"),
                     "page-texts")
