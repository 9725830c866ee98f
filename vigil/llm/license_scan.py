"""License scan with ordered signature rules, in DataFrame expressions only.

A text is looked at in three steps, each gating the next:

* ``ANCHOR``: one regex that every rule implies; most texts end here;
* keyword prefilter: a family's rules are tried only if its literal keyword occurs;
* the rules, in order of priority: ``NOTICES``, what licenses and their notices say themselves; each family's name in
  each of the ``FORMS`` (a product of names and sentences, several hundred regexes); bare ``IDENTIFIERS``; ``OWN_RULES``.

Detections are resolved as follows. One that lies within another is suppressed (of equal
ones that of the earlier rule stays). Of two that overlap in part the earlier rule's stays.
All of it is per-row expressions: no shuffle, no join, no Python.

Besides, the places of given base phrases are counted by words. Their labels always stay.

Nulls: a null text is empty; empty texts give zero counts, null places, empty labels and a
score of 0. Null ids are kept. Repeated rows give repeated results. An empty table gives an
empty result. Only the id and text columns are read, so other names can't clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: words once A-Z are lower-cased: ASCII letters, digits and everything beyond ASCII
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANCHOR = (r"(?i)licen[cs]|spdx|(?:released|distributed|published|available|provided)\s+under|subject\s+to|rights\s+reserved|public\s+domain"
          r"|permission\s+(?:is\s+hereby|to\s+use)|redistribution\s+and|contributors\s+may|advertising\s+materials|altered\s+source|openssl\s+project|unencumbered"
          r"|(?:gpl|gfdl|apache|bsd|mpl|epl|eupl|cc-by|cc0|bsl|artistic|ofl|cddl|afl|osl|cpl)-[0-9n-s]")

_V = r"(?:,?\s*(?:v|ver\.?|version)?\s*"
#: label, keyword that the name contains, name as a regex over lower-cased text
FAMILIES = (
    ("mit", "mit", r"(?:mit|expat)"),
    ("x11", "x11", r"x11"),
    ("mit-0", "mit-0", r"mit-0"),
    ("apache-2.0", "apache", rf"apache(?:\s+software)?(?:\s+licen[cs]e)?{_V}2(?:\.0)?)"),
    ("apache-1.1", "apache", rf"apache(?:\s+software)?(?:\s+licen[cs]e)?{_V}1\.1)"),
    ("apache", "apache", r"apache(?:\s+software)?"),
    ("gpl-3.0", "g", rf"(?:gnu\s+)?(?:gpl|general\s+public\s+licen[cs]e){_V}3(?:\.0)?)"),
    ("gpl-2.0", "g", rf"(?:gnu\s+)?(?:gpl|general\s+public\s+licen[cs]e){_V}2(?:\.0)?)"),
    ("gpl", "g", r"(?:gnu\s+)?(?:gpl|general\s+public)"),
    ("lgpl-3.0", "l", rf"(?:gnu\s+)?(?:lgpl|lesser\s+general\s+public\s+licen[cs]e){_V}3(?:\.0)?)"),
    ("lgpl-2.1", "l", rf"(?:gnu\s+)?(?:lgpl|lesser\s+general\s+public\s+licen[cs]e){_V}2\.1)"),
    ("lgpl", "l", r"(?:gnu\s+)?(?:lgpl|(?:lesser|library)\s+general\s+public)"),
    ("agpl-3.0", "a", rf"(?:gnu\s+)?(?:agpl|affero\s+general\s+public\s+licen[cs]e){_V}3(?:\.0)?)"),
    ("agpl", "a", r"(?:gnu\s+)?(?:agpl|affero\s+general\s+public)"),
    ("gfdl", "g", r"(?:gnu\s+)?(?:gfdl|free\s+documentation)"),
    ("bsd-2-clause", "bsd", r"(?:bsd[\s-]2[\s-]clause|2[\s-]clause\s+bsd|simplified\s+bsd|freebsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd[\s-]3[\s-]clause|3[\s-]clause\s+bsd|(?:new|modified|revised)\s+bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd[\s-]4[\s-]clause|4[\s-]clause\s+bsd|original\s+bsd)"),
    ("0bsd", "0bsd", r"0bsd"),
    ("bsd", "bsd", r"bsd"),
    ("isc", "isc", r"isc"),
    ("mpl-2.0", "m", rf"(?:mpl|mozilla\s+public\s+licen[cs]e){_V}2(?:\.0)?)"),
    ("mpl-1.1", "m", rf"(?:mpl|mozilla\s+public\s+licen[cs]e){_V}1\.1)"),
    ("mpl", "m", r"(?:mpl|mozilla\s+public)"),
    ("epl-2.0", "e", rf"(?:epl|eclipse\s+public\s+licen[cs]e){_V}2(?:\.0)?)"),
    ("epl-1.0", "e", rf"(?:epl|eclipse\s+public\s+licen[cs]e){_V}1(?:\.0)?)"),
    ("eupl-1.2", "e", rf"(?:eupl|european\s+union\s+public\s+licen[cs]e){_V}1\.2)"),
    ("cddl", "c", r"(?:cddl|common\s+development\s+and\s+distribution)"),
    ("cpl-1.0", "c", rf"(?:cpl|common\s+public\s+licen[cs]e){_V}1(?:\.0)?)"),
    ("cc0-1.0", "c", rf"(?:cc0|creative\s+commons\s+zero){_V}1\.0)?"),
    ("cc-by-nc-nd", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution)-(?:nc|noncommercial)-(?:nd|noderivatives|noderivs){_V}[1-4]\.[0-9])?"),
    ("cc-by-nc-sa", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution)-(?:nc|noncommercial)-(?:sa|sharealike){_V}[1-4]\.[0-9])?"),
    ("cc-by-nc", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution)-(?:nc|noncommercial){_V}[1-4]\.[0-9])?"),
    ("cc-by-nd", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution)-(?:nd|noderivatives|noderivs){_V}[1-4]\.[0-9])?"),
    ("cc-by-sa", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution)-(?:sa|sharealike){_V}[1-4]\.[0-9])?"),
    ("cc-by", "c", rf"(?:cc|creative\s+commons)[\s-]+(?:by|attribution){_V}[1-4]\.[0-9])?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtf", r"(?:wtfpl|do\s+what\s+the\s+fuck\s+you\s+want\s+to\s+public)"),
    ("zlib", "zlib", r"zlib(?:/libpng)?"),
    ("bsl-1.0", "boost", r"boost(?:\s+software)?"),
    ("artistic-2.0", "artistic", rf"artistic(?:\s+licen[cs]e)?{_V}2(?:\.0)?)"),
    ("artistic", "artistic", r"artistic"),
    ("ofl-1.1", "o", rf"(?:sil\s+)?(?:ofl|open\s+font\s+licen[cs]e){_V}1\.1)?"),
    ("psf-2.0", "p", r"(?:psf|python(?:\s+software\s+foundation)?)"),
    ("php-3.01", "php", rf"php(?:\s+licen[cs]e)?{_V}3\.0?1)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ms-pl", "ms-pl", r"ms-pl"),
    ("ms-pl", "microsoft", r"microsoft\s+public"),
    ("ms-rl", "microsoft", r"microsoft\s+reciprocal"),
    ("odbl", "o", r"(?:odbl|open\s+database)"),
    ("pddl", "p", r"(?:pddl|public\s+domain\s+dedication\s+and)"),
    ("ncsa", "ncsa", r"(?:university\s+of\s+illinois/)?ncsa(?:\s+open\s+source)?"),
    ("afl-3.0", "a", rf"(?:afl|academic\s+free\s+licen[cs]e){_V}3(?:\.0)?)?"),
    ("osl-3.0", "o", rf"(?:osl|open\s+software\s+licen[cs]e){_V}3(?:\.0)?)?"),
    ("cecill", "cecill", r"cecill(?:-[bc])?"),
    ("mulan-2.0", "mulan", rf"mulan\s+(?:psl|permissive\s+software\s+licen[cs]e){_V}2)?"),
    ("public-domain", "public domain", r"public\s+domain"),
)
#: confidence, regex around the name, in order of priority
FORMS = (
    (0.99, r"spdx-licen[cs]e-identifier:\s*\(?{name}\b"),
    (0.95, r"licen[cs]ed\s+(?:to\s+you\s+)?under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}\b(?:\s+licen[cs]e)?"),
    (0.95, r"(?:released|distributed|published|available|provided)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}\b(?:\s+licen[cs]e)?"),
    (0.9, r"subject\s+to\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?{name}\b(?:\s+licen[cs]e)?"),
    (0.8, r"\blicen[cs]e\s*[:=]\s*[\x22']?{name}\b"),
    (0.7, r"\b{name}\s+licen[cs]e\b(?:{version})?"),
)
_VERSION = r",?\s*(?:v|version)\s*[0-9]+(?:\.[0-9]+)*"
_AS_GNU = r"free\s+software[:;,]\s+you\s+can\s+redistribute\s+it\s+and(?:/|\s+)or\s+modify\s+it\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+{kind}general\s+public\s+license"
_AS_FSF = r"{head}\s+as\s+published\s+by\s+the\s+free\s+software\s+foundation[,;]\s+(?:either\s+)?version\s+{version}"
_FREE = r"permission\s+is\s+hereby\s+granted,\s+free\s+of\s+charge,\s+to\s+any\s+person\s+"
_USE = r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+"


def _gnu(kind: str, version: str | None = None) -> str:
    head = _AS_GNU.replace("{kind}", kind)
    return head if version is None else _AS_FSF.replace("{head}", head).replace("{version}", version)


#: what the texts of licenses and the notices that refer to them say: label, keyword, confidence, regex
NOTICES = (
    ("bsl-1.0", "hereby", 0.97, _FREE + r"or\s+organization\s+obtaining\s+a\s+copy\s+of\s+the\s+software\s+and\s+accompanying\s+documentation"),
    ("mit", "hereby", 0.95, _FREE + r"obtaining\s+a\s+copy"),
    ("postgresql", "hereby", 0.97, _USE + r"and\s+its\s+documentation\s+for\s+any\s+purpose,\s+without\s+fee,\s+and\s+without\s+a\s+written\s+agreement\s+is\s+hereby\s+granted"),
    ("isc", "hereby", 0.97, _USE + r"for\s+any\s+purpose\s+with\s+or\s+without\s+fee\s+is\s+hereby\s+granted,\s+provided"),
    ("0bsd", "hereby", 0.95, _USE + r"for\s+any\s+purpose\s+with\s+or\s+without\s+fee\s+is\s+hereby\s+granted\."),
    ("bsd-4-clause", "advertising", 0.95, r"all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software"),
    ("bsd-3-clause", "contributors", 0.95, r"nor\s+the\s+names\s+of\s+(?:its|their|the)\s+contributors\s+may\s+be\s+used\s+to\s+endorse"),
    ("bsd", "redistribution", 0.9, r"redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms,\s+with\s+or\s+without\s+modification,\s+are\s+permitted"),
    ("gpl-3.0", "redistribute", 0.97, _gnu("", "3")),
    ("gpl-2.0", "redistribute", 0.97, _gnu("", "2")),
    ("gpl", "redistribute", 0.95, _gnu("")),
    ("lgpl-3.0", "redistribute", 0.97, _gnu(r"lesser\s+", "3")),
    ("lgpl-2.1", "redistribute", 0.97, _gnu(r"lesser\s+", r"2\.1")),
    ("lgpl", "redistribute", 0.95, _gnu(r"(?:lesser|library)\s+")),
    ("agpl-3.0", "redistribute", 0.97, _gnu(r"affero\s+", "3")),
    ("agpl", "redistribute", 0.95, _gnu(r"affero\s+")),
    ("gpl-3.0", "copyleft", 0.97, r"the\s+gnu\s+general\s+public\s+license\s+is\s+a\s+free,?\s+copyleft\s+license\s+for\s+software"),
    ("agpl-3.0", "copyleft", 0.97, r"the\s+gnu\s+affero\s+general\s+public\s+license\s+is\s+a\s+free,?\s+copyleft\s+license\s+for\s+software"),
    ("gpl", "freedom", 0.9, r"the\s+licenses\s+for\s+most\s+software\s+(?:and\s+other\s+practical\s+works\s+)?are\s+designed\s+to\s+take\s+away\s+your\s+freedom"),
    ("apache-2.0", "apache", 0.97, r"licensed\s+under\s+the\s+apache\s+license,\s+version\s+2\.0\s+\(the\s+[\x22']?license[\x22']?\);\s+you\s+may\s+not\s+use"),
    ("apache-2.0", "applicable", 0.9, r"unless\s+required\s+by\s+applicable\s+law\s+or\s+agreed\s+to\s+in\s+writing,\s+software\s+distributed\s+under\s+the\s+license\s+is\s+distributed\s+on\s+an"),
    ("mpl-2.0", "mozilla", 0.97, r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+license,\s+v\.\s+2\.0"),
    ("mpl-1.1", "mozilla", 0.97, r"contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+mozilla\s+public\s+license\s+version\s+1\.1"),
    ("epl-2.0", "eclipse", 0.97, r"accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse\s+public\s+license\s+(?:v\.?|version)\s*2\.0"),
    ("epl-1.0", "eclipse", 0.97, r"accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse\s+public\s+license\s+(?:v\.?|version)\s*1\.0"),
    ("cddl", "development", 0.97, r"subject\s+to\s+the\s+terms\s+of\s+the\s+common\s+development\s+and\s+distribution\s+license"),
    ("zlib", "altered", 0.95, r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked\s+as\s+such"),
    ("unlicense", "unencumbered", 0.97, r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain"),
    ("wtfpl", "verbatim", 0.95, r"copy\s+and\s+distribute\s+verbatim\s+or\s+modified\s+copies\s+of\s+this\s+license\s+document,\s+and\s+changing\s+it\s+is\s+allowed"),
    ("cc0-1.0", "deed", 0.95, r"associated\s+a\s+work\s+with\s+this\s+deed\s+has\s+dedicated\s+the\s+work\s+to\s+the\s+public\s+domain"),
    ("openssl", "openssl", 0.95, r"this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+openssl\s+project"),
    ("psf-2.0", "psf", 0.95, r"this\s+license\s+agreement\s+is\s+between\s+the\s+python\s+software\s+foundation\s+\([\x22']?psf[\x22']?\)"),
    ("ms-pl", "accompanying", 0.6, r"this\s+license\s+governs\s+use\s+of\s+the\s+accompanying\s+software"),
    ("gfdl", "documentation", 0.97, r"copy,\s+distribute\s+and/or\s+modify\s+this\s+document\s+under\s+the\s+terms\s+of\s+the\s+gnu\s+free\s+documentation\s+license"),
)
#: bare identifiers: label, regex of how they are written
IDENTIFIERS = (
    ("gpl-3.0", r"gpl-3\.0(?:-only|-or-later)?"), ("gpl-2.0", r"gpl-2\.0(?:-only|-or-later)?"), ("lgpl-3.0", r"lgpl-3\.0(?:-only|-or-later)?"),
    ("lgpl-2.1", r"lgpl-2\.1(?:-only|-or-later)?"), ("agpl-3.0", r"agpl-3\.0(?:-only|-or-later)?"), ("gfdl", r"gfdl-1\.[1-3](?:-only|-or-later)?"),
    ("apache-2.0", r"apache-2\.0"), ("apache-1.1", r"apache-1\.1"), ("bsd-2-clause", r"bsd-2-clause"), ("bsd-3-clause", r"bsd-3-clause"), ("bsd-4-clause", r"bsd-4-clause"),
    ("mpl-2.0", r"mpl-2\.0"), ("mpl-1.1", r"mpl-1\.1"), ("epl-2.0", r"epl-2\.0"), ("epl-1.0", r"epl-1\.0"), ("eupl-1.2", r"eupl-1\.2"), ("cddl", r"cddl-1\.[01]"),
    ("cpl-1.0", r"cpl-1\.0"), ("cc0-1.0", r"cc0-1\.0"), ("cc-by", r"cc-by-[1-4]\.[05]"), ("cc-by-sa", r"cc-by-sa-[1-4]\.[05]"), ("cc-by-nd", r"cc-by-nd-[1-4]\.[05]"),
    ("cc-by-nc", r"cc-by-nc-[1-4]\.[05]"), ("cc-by-nc-sa", r"cc-by-nc-sa-[1-4]\.[05]"), ("cc-by-nc-nd", r"cc-by-nc-nd-[1-4]\.[05]"), ("bsl-1.0", r"bsl-1\.0"),
    ("artistic-2.0", r"artistic-2\.0"), ("ofl-1.1", r"ofl-1\.1"), ("afl-3.0", r"afl-3\.0"), ("osl-3.0", r"osl-3\.0"),
)
IDENTIFIER_CONFIDENCE = 0.8
OWN_RULES = (("all-rights-reserved", "reserved", 0.6, r"\ball\s+rights\s+reserved\b"),
             ("public-domain", "public domain", 0.6, r"(?:dedicated\s+to|placed\s+in(?:to)?)\s+the\s+public\s+domain\b"))
BASE_SCORE = 0.5
DETECTION, RUN = "struct<start:int,end:int,order:int,label:string,confidence:double>", 128


def rules() -> list[tuple[str, str, float, str]]:
    """``label, keyword, confidence, regex`` in order of priority."""
    made = [(label, key, conf, form.replace("{version}", _VERSION).replace("{name}", f"(?:{name})"))
            for conf, form in FORMS for label, key, name in FAMILIES]
    bare = [(label, label[:3], IDENTIFIER_CONFIDENCE, rf"\b{name}\b") for label, name in IDENTIFIERS]
    return list(NOTICES) + made + bare + list(OWN_RULES)


def _prefilter() -> list[tuple[str, list[tuple[int, str, float, str]]]]:
    by_key: dict[str, list] = {}
    for order, (label, key, conf, regex) in enumerate(rules()):
        by_key.setdefault(KEYWORDS.get(key, key), []).append((order, label, conf, regex))
    return sorted(by_key.items())


#: families whose name has two spellings are gated by a regex of both
KEYWORDS = {"mit": "mit|expat", "public domain": r"public\s+domain", "g": r"gnu|gpl|general\s+public|gfdl|free\s+documentation", "l": r"lgpl|lesser|library", "a": r"affero|agpl|afl|academic\s+free",
            "m": r"mozilla|mpl", "e": r"eclipse|epl|eupl|european", "c": r"creative|cc|cddl|common|cpl",
            "o": r"open|ofl|odbl|osl", "p": r"psf|python|pddl|dedication", "wtf": "wtf|fuck"}


def _running(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """``state, out``: a state carried through ``items``, and the detections that the steps give (null: none).

    ``aggregate`` copies what it has gathered at every step. So items are taken in runs of ``RUN``:
    a step copies its run's detections, and only each run's array is added to those of the runs before."""
    none = F.array().cast(f"array<{DETECTION}>")

    def cut(whole: Column) -> Column:
        last = F.floor((F.size(whole) - 1) / RUN).cast("int")
        return F.when(F.size(whole) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(whole, k * RUN + 1, RUN))).otherwise(F.array_repeat(whole, 0))

    runs = F.flatten(F.transform(F.array(items), cut))  # bound by a lambda, so computed once

    def one(acc: Column, item: Column) -> Column:
        state, found = step(acc["state"], item)
        return F.struct(state.alias("state"), F.when(found.isNull(), acc["out"]).otherwise(F.concat(acc["out"], F.array(found))).alias("out"))

    def run(done: Column, some: Column) -> Column:  # a lambda over the gathered arrays would copy them whole, so none is used here
        return F.concat(done, F.array(F.aggregate(some, F.struct(F.element_at(done, -1)["state"].alias("state"), none.alias("out")), one)))

    return F.aggregate(runs, F.array(F.struct(start.alias("state"), none.alias("out"))), run,
                       lambda done: F.struct(F.element_at(done, -1)["state"].alias("state"), F.flatten(F.transform(done, lambda g: g["out"])).alias("out")))


def _detections(low: Column) -> Column:
    """Array of ``start, end, order, label, confidence`` of all rules' matches in ``low``."""
    table = F.array(*[F.struct(F.lit(key).alias("key"), F.array(*[
        F.struct(F.lit(o).alias("order"), F.lit(label).alias("label"), F.lit(conf).alias("confidence"), F.lit(regex).alias("regex"))
        for o, label, conf, regex in some]).alias("rules")) for key, some in _prefilter()])
    tried = F.flatten(F.transform(F.filter(table, lambda f: F.rlike(low, f["key"])), lambda f: f["rules"]))

    def places(r: Column) -> Column:
        # the pieces between the matches and the matches take turns, so their lengths give the places
        step = F.zip_with(F.split(low, r["regex"], -1), F.regexp_extract_all(low, r["regex"], F.lit(0)),
                          lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("hit")))
        return _running(F.filter(step, lambda s: s["hit"].isNotNull()), F.lit(0), lambda at, s: (at + s["gap"] + s["hit"], F.struct(
            (at + s["gap"]).alias("start"), (at + s["gap"] + s["hit"]).alias("end"),
            r["order"].alias("order"), r["label"].alias("label"), r["confidence"].alias("confidence"))))["out"]

    return F.flatten(F.transform(F.filter(tried, lambda r: F.rlike(low, r["regex"])), places))


def _resolved(found: Column) -> Column:
    """The detections that no other suppresses, in order."""
    by_place = F.transform(F.array_sort(F.transform(found, lambda d: F.struct(
        d["start"].alias("start"), (-d["end"]).alias("back"), d["order"].alias("order"), d["label"].alias("label"), d["confidence"].alias("confidence")))),
        lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["order"].alias("order"), d["label"].alias("label"), d["confidence"].alias("confidence")))

    def step(last: Column, d: Column) -> tuple[Column, Column]:
        apart = d["start"] >= last["end"]
        better = (d["end"] > last["end"]) & (d["order"] < last["order"])
        return F.when(last.isNull() | apart | better, d).otherwise(last), F.when(last.isNotNull() & apart, last)

    done = F.transform(F.array(_running(by_place, F.lit(None).cast(DETECTION), step)),
                       lambda r: F.when(r["state"].isNull(), r["out"]).otherwise(F.concat(r["out"], F.array(r["state"]))))
    return F.element_at(done, 1)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """``id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    any_last = "|".join(sorted({p.split()[-1] for p in phrases}))
    # A-Z and a-z alike are letters here, so words can be counted before lower-casing
    words = F.regexp_extract_all(F.col("text"), F.lit(WORD.replace(r"\x3A-\x60", r"\x3A-\x40\x5B-\x60")), F.lit(0))
    df = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    df = df.select("id", words.alias("words"),
                   F.when(F.rlike("text", F.lit(f"(?i){any_last}")), F.lit(True)).alias("based"),
                   F.when(F.rlike("text", F.lit(ANCHOR)), F.lower("text")).alias("low"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    df = df.select("id", F.size("words").cast("long").alias("n_words"), "low",
                   F.when(F.col("based") & (F.size("words") > 0), F.transform("words", lambda w: F.translate(w, upper, lower))).alias("w"))

    def starts(phrase: str) -> Column:
        parts = phrase.split()
        same = lambda i: reduce(lambda x, y: x & y, [F.get("w", i + j) == F.lit(p) for j, p in enumerate(parts)])
        return F.when(F.col("w").isNotNull(), F.filter(F.sequence(F.lit(0), F.size("w") - 1), same)).otherwise(F.array().cast("array<int>"))

    hits = {f"hit{n}": starts(p) for n, p in enumerate(phrases)}
    df = df.select("id", "n_words", *[c.alias(n) for n, c in hits.items()],
                   F.when(F.col("low").isNotNull(), _detections(F.col("low"))).otherwise(
                       F.array().cast(f"array<{DETECTION}>")).alias("found"))
    df = df.withColumn("detections", _resolved(F.col("found")))
    every = F.flatten(F.array(*hits))
    base = F.array_compact(F.array(*[F.when(F.size(h) > 0, F.lit(label)) for h, label in zip(hits, phrases.values())]))
    return df.select(
        "id", "n_words", F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)),
                   F.when(F.size(every) > 0, F.lit(BASE_SCORE)).otherwise(0.0)).alias("score"), "detections")
