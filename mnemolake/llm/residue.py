"""Template residue and error-page text (problem 7): delimiter grammars, phrases, context, density.

A record is residue if it is, or contains, one of

* an unfilled template place: one grammar per delimiter (``{{x}}``, ``${x}``, ``{x}``, ``{0}``, ``[[x]]``,
  ``<%= x %>``, ``%x%``, ``$x$``, ``__x__``, ``*|X|*``, ``<x_y>``, ``<YOUR x>``, ``[INSERT x HERE]``, ``[First Name]``, ``[TITLE]``);
* filler: runs of dummy-Latin words, one word again and again, sentences that stand in for text
  ("sample text", "enter a title here", "click to edit");
* an error page or an error message served in place of content: status lines (code and reason of
  HTTP), and sentences of a grammar *thing + failure* ("the page ... could not be ...", "your session
  has expired"), apologies, refusals, robot checks, maintenance notices;
* a notice that scripts are needed: a grammar of *scripts + state* and *switch on + scripts*.

What only speaks of such things is discounted by its surroundings, for all detectors: code fences,
inline code and quoted strings are blanked first (but not in JSON, whose strings are its content); a
sentence about templates or placeholders (a tutorial) does not count unless places stand denser
than its words about them; status lines, apologies and demands count only where a line or sentence
begins with them; two dummy-Latin words are a mention, a run of ``LATIN_RUN`` is filler; a word
that people repeat for emphasis is no filler.

The phrases are written as grammars of what such pages say, in English and, shorter, in German,
Spanish and Russian; unseen wordings outside of them are missed.

Everything is JVM regular expressions behind cheap substring tests, so most rows never meet a
pattern. Defined results: null and empty text is no residue; an id delivered several times is
reported once, if any of its rows is residue; null ids are ignored.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.functions.timestamps import once
from mnemolake.llm.conversations import message_text

LATIN_RUN = 4

# Element names of HTML, which are no template places.
HTML_TAGS = [
    "a", "abbr", "article", "aside", "audio", "b", "base", "blockquote", "body", "br", "button", "canvas", "caption", "cite", "code",
    "col", "data", "dd", "del", "details", "dialog", "div", "dl", "dt", "em", "embed", "fieldset", "figure", "footer", "form",
    "frame", "head", "header", "hr", "html", "i", "iframe", "img", "input", "ins", "kbd", "label", "legend", "li", "link", "main",
    "map", "mark", "menu", "meta", "nav", "noscript", "object", "ol", "optgroup", "option", "output", "p", "param", "picture",
    "pre", "progress", "q", "s", "samp", "script", "section", "select", "slot", "small", "source", "span", "strike", "strong",
    "style", "sub", "summary", "sup", "svg", "table", "tbody", "td", "template", "textarea", "tfoot", "th", "thead", "time",
    "title", "tr", "track", "tt", "u", "ul", "var", "video", "wbr",
]
# Words of dummy Latin.
LATIN = [
    "lorem", "ipsum", "dolor", "sit", "amet", "consectetur", "adipiscing", "elit", "sed", "eiusmod", "tempor", "incididunt", "labore",
    "magna", "aliqua", "urna", "massa", "vitae", "velit", "odio", "quam", "porta", "tempus", "justo", "nulla", "nunc", "mauris", "ut", "et",
]
# Status reasons.
REASONS = [
    "Bad Request", "Unauthorized", "Payment Required", "Forbidden", "Not Found", "Method Not Allowed", "Not Acceptable", "Request Time-?out",
    "Conflict", "Gone", "Too Many Requests", "Internal Server Error", "Not Implemented", "Bad Gateway", "Service Unavailable", "Gateway Time-?out",
]

_NAME = r"[A-Za-z_][A-Za-z0-9_.]{0,40}"
#: tag names also used as the name of a place when written in capitals or with a prefix
_TAG = "(?i:" + "|".join(t for t in HTML_TAGS if t not in ("summary",)) + ")"
PLACES = [
    r"\{\{[^{}]+\}\}",
    r"\$\{[^{}]+\}",
    rf"(?<![\w\\/$\{{}}])\{{(?:[A-Za-z_][A-Za-z0-9_.]{{1,40}}|\d{{1,2}})\}}(?!\}})",
    r"<%=?[^%]+%>",
    rf"\[\[\s*{_NAME}\s*\]\]",
    r"(?<![\w%])%[A-Za-z][A-Za-z_]{2,40}%(?![\w%])",
    r"%\([A-Za-z_]+\)s",
    r"(?<![\w$])\$[A-Za-z][A-Za-z_]{2,40}\$(?![\w$])",
    r"(?<!\w)__(?!(?i:init|main|name|file|dict|class|doc|all|call|str|repr|version)__)[A-Za-z]\w*?__(?!\w)",
    r"\*\|[A-Z][A-Z0-9_:]*\|\*",
    r"<(?i:your|insert|enter|add)[ _-][^<>]+>",
    r"(?<!\w)<[A-Za-z][A-Za-z0-9]*_[A-Za-z0-9_]+>",
    rf"(?<!\w)<(?!{_TAG}>)[A-Za-z]{{3,30}}>(?![^\n]{{0,200}}</)",
    r"\[(?i:insert|enter|add|describe|fill in|write|type|your)\b[^\[\]]+\](?!\()",
    r"\[(?:WHAT|WHO|WHEN|WHERE|WHY|HOW)\b[A-Z ,?']{2,60}\](?!\()",
    r"\[(?:[A-Z][a-z]+ ){1,2}(?:Name|Title|Date|Address|Number|Email|Here)\](?!\()",
    r"\[(?:TITLE|NAME|DATE|CITY|COMPANY|SUBJECT|BODY|AMOUNT|ADDRESS|SUMMARY|PROJECT|AGENT|TOPIC|TEXT|LINK|TBD|TODO)\](?!\()",
]
_PLACE = "|".join(PLACES)

_B = r"(?:^|[\n\r>|]\s*|[.!?…]\s+|:\s+|[-*]\s+|\)\s+)"  # where a line or sentence begins
_E = r"(?:\s*$|\s*[\n\r.!,;:…<(]|\s+-\s)"  # where it, or a clause of it, ends
_REASON = "(?i:" + "|".join(REASONS) + ")"
_W = r"[\p{L}\p{N}'’/_.-]+"  # a word, a path or a reference number

# What can fail, and how a page says so.
_THING = r"(?:requested )?(?:page|url|resource|file|document|link|site|website|server|service|request|content|session|account|address)"
_FAILED = (
    r"(?:(?:could|can|was|is|does|did|were|are)\s?(?:not|n't|n’t)(?: be| currently| longer)? (?:found|available|served|exist|reached|reachable|displayed|shown|loaded|handled?|processed?|completed?|respond|accessible)"
    r"|cannot be (?:found|served|reached|displayed|loaded|processed)|no longer (?:exists|available)|(?:has |have )?(?:expired|timed out)|is broken|(?:has|have) been (?:moved|removed|deleted|blocked|suspended)|is (?:down|unavailable|temporarily unavailable))"
)
_LONE = r"(?:page|file|site|server|resource|url) (?:is )?(?:not found|unavailable|not available|unreachable)"

FILLER = [
    rf"{_B}(?:this is |here is |here goes )?(?:an? |the |some |your )?(?:placeholder|dummy|sample|filler|example|blind) (?:text|content|copy|paragraph)(?: (?:for|goes|comes|here|only)\b|{_E})",
    rf"{_B}your (?:{_W} ){{0,2}}?(?:text|title|content|name|message|heading|headline) (?:goes |comes )?here\b",
    rf"{_B}(?:insert|enter|type|put|write|add|paste) (?:{_W} ){{1,3}}here{_E}",
    rf"{_B}(?:click|tap|double-click) (?:here )?to (?:edit|add|change|enter)\b",
    rf"{_B}type something{_E}", rf"{_B}add an? (?:short )?(?:description|title|caption|subtitle|heading) (?:of|for|to|here)\b",
    rf"{_B}replace (?:it|this|me)(?: text| content)? (?:before (?:use|publishing|you)|with your)\b",
    r"\b(?:hier steht|hier kommt|geben sie) (?:ihr|ihren|dein|der|später)\s?(?:text|titel|inhalt)?\b", r"\b(?:blindtext|mustertext|platzhaltertext|beispieltext)\b(?=[^.!?\n]{0,20}(?:$|[.!?\n]))",
    r"\b(?:su|tu|el) (?:texto|título|contenido) (?:va )?aquí\b", r"\btexto de (?:relleno|ejemplo|prueba)(?:$|[.!\n])", r"(?:здесь|тут) (?:будет|должен быть) (?:ваш )?(?:текст|заголовок)|введите (?:ваш )?текст|ваш текст (?:здесь|тут)",
]
ERROR = [
    rf"{_B}(?:oops|whoops|uh-oh|oh no|sorry|we(?:'|’)re sorry|we are sorry|apologies)[!,.… ]+(?:but )?(?:{_W},? ){{0,5}}?(?:went wrong|go(?:ne)? wrong|not found|(?:can(?:not|'t|’t| not)|could\s?n(?:'t|’t|ot)|unable to) (?:find|load|open|show|display|process|complete)|unavailable|occurred|broke)",
    rf"{_B}something (?:has )?(?:went|gone) (?:badly |terribly )?wrong{_E}",
    rf"{_B}(?:a |an |the )?(?:fatal |internal |application |server |runtime |database |unknown |unexpected |client-side )+(?:error|exception)(?: has| was)?(?: occurred|:| {_E})",
    rf"{_B}error (?:establishing|connecting|loading|processing|while (?:loading|processing|connecting))\b",
    rf"{_B}upstream (?:connect error|server|request|prematurely|timed)", rf"{_B}(?:connection|request|gateway|operation) (?:has )?(?:timed out|refused|reset by peer){_E}",
    rf"{_B}(?:your |this |the )?session (?:has |is )?(?:expired|timed out)\b", rf"{_B}(?:(?:oops|whoops|sorry)[!,.… ]+)?(?:the |this |that |your )?{_THING} (?:{_W} ){{0,2}}?{_FAILED}", rf"{_B}{_LONE}{_E}",
    rf"{_B}no (?:healthy )?(?:server|upstream|backend|host) (?:is |was |are )?(?:currently )?(?:available|found|reachable)\b",
    rf"{_B}(?-i:A(?:ccess|CCESS)|P(?:ermission|ERMISSION)) (?:is |was )?(?:denied|forbidden){_E}", rf"{_B}you (?:do not|don't|don’t|are not) (?:have (?:permission|access|the rights?)|authori[sz]ed|allowed|permitted) (?:to|for)\b",
    rf"{_B}(?:unusual|suspicious|automated|abnormal) (?:traffic|activity|requests?) (?:was |were |has been |have been )?(?:detected|coming|from)\b",
    rf"{_B}(?:checking|verifying|confirm|verify|prove|making sure|please (?:confirm|verify|prove))\b[^.!?\n]{{0,30}}?(?:you are|you(?:'|’)re) (?:not )?(?:an? )?(?:human|robot|bot|person)\b", rf"{_B}checking your browser\b",
    rf"{_B}(?:this |the )?(?:content|video|page|site|service|article) (?:is|has been) (?:blocked|unavailable|not available|restricted) in your (?:region|country|area|location)\b",
    rf"{_B}(?:we are |the site is |this site is |the service is )?(?:temporarily |currently )?(?:down|closed|offline|unavailable) for (?:scheduled |planned |routine )?maintenance\b", rf"{_B}(?:service|site|page|server) (?:is )?temporarily unavailable\b",
    rf"{_B}(?:please )?try again (?:later|in (?:a few|\d+|a) (?:minutes?|moments?|seconds?|while)), (?:incident|reference|request|error)\b",
    r"\bpágina (?:\S+ )?(?:no (?:se )?(?:encontrada|encontró|existe|está disponible))", r"\bseite (?:\S+ )?(?:nicht gefunden|existiert nicht|konnte nicht (?:gefunden|geladen)|ist nicht (?:verfügbar|erreichbar))", r"страница (?:\S+ )?(?:не найдена|не существует|недоступна)",
    rf"{_B}(?:zugriff verweigert|acceso denegado|доступ запрещ[её]н)", rf"{_B}(?:etwas ist schiefgelaufen|algo salió mal|что-то пошло не так)",
]
_JS = r"(?:java\s?script|scripts|scripting|js)"
SCRIPTS = [
    rf"{_B}(?:(?:{_W},? ){{0,6}}?(?:please|need to|have to|must|should) )?(?:enable|activate|allow|turn on|switch on|permit) (?:{_W} ){{0,2}}?{_JS}\b(?= (?:to|for|in your|in the|and|or|on|so)\b|{_E})",
    rf"{_B}(?:{_W} ){{0,4}}?{_JS} (?:is|are|must be|has to be|have to be|needs? to be|seems? to be|appears? to be) (?:currently )?(?:disabled|turned off|switched off|off|blocked|not (?:enabled|supported|available|allowed)|turned on|switched on|enabled|allowed|activated|required)\b(?= in your| for | to | by |{_E})",
    rf"\bturn (?:{_JS}) on (?:to|and|in)\b", rf"\b(?:browser|device|client) (?:does not|doesn't|doesn’t|cannot|can't|can’t) (?:support|run|execute) {_JS}\b",
    rf"{_B}(?:this|the|our) (?:{_W} ){{1,3}}?(?:requires?|needs?) (?:cookies and |a browser with )?{_JS}\b", rf"{_B}(?:this|the|our) (?:{_W} ){{1,4}}?(?:works?|runs?|loads?) only with {_JS}\b",
    r"\baktivieren sie (?:\w+ )?javascript\b|\bjavascript (?:ist|wurde) (?:deaktiviert|ausgeschaltet)|\bjavascript aktivieren\b", r"\b(?:active|habilite|activa|habilita|activar|habilitar) (?:\S+ ){0,3}?(?:javascript|scripts)\b", r"включите (?:поддержку )?javascript|javascript (?:отключ[её]н|выключен|не поддерживается)",
]
# Words that people repeat for emphasis or laughter.
EMPHASIS = ["very", "really", "so", "too", "much", "many", "more", "far", "no", "yes", "ha", "haha", "never", "sehr", "ja", "nein", "muy", "mucho", "очень", "да", "нет"]


def _phrases(lines: list[str]) -> str:
    """One pattern: what begins with ``_B`` shares it, so most places of a text are left at once."""
    starts = [x[len(_B) :] for x in lines if x.startswith(_B)]
    inside = [x for x in lines if not x.startswith(_B)]
    return "(?iu)(?:" + _B + "(?:" + "|".join(x.replace(" ", r"\s+") for x in starts) + ")|" + "|".join(x.replace(" ", r"\s+") for x in inside) + ")"


def _any(text: Column, needles: list[str]) -> Column:
    return reduce(or_, [text.contains(n) for n in needles])


def shown(text: Column) -> Column:
    """``text`` with code and quotation blanked; the strings of a JSON value stay."""
    plain = F.regexp_replace(text, r"(?s)```.*?(?:```|$)|~~~.*?(?:~~~|$)", " ")
    plain = F.regexp_replace(plain, r"`[^`\n]*`", " ")
    is_json = text.rlike(r"^\s*[\[{]\s*[\"{\[]")
    quoted = F.regexp_replace(plain, r"\"[^\"\n]{0,300}\"|“[^”\n]{0,300}”|„[^“\n]{0,300}“|«[^»\n]{0,300}»", " ")
    return F.when(~_any(text, ["`", "~~~", '"', "“", "„", "«"]), text).when(is_json, plain).otherwise(quoted)


def has_place(text: Column) -> Column:
    """An unfilled template place outside talk about templates."""
    # a sentence that explains: one or two places among at least six words each are a mention
    about = r"(?i)[^.!?\n]*\b(?:placeholders?|template|templates|syntax|variables?|markup|snippet|jinja|handlebars|to mean|stands for|(?:is|are|gets?) replaced)\b[^.!?\n]*"
    dense = rf"(?:{_PLACE})(?:\W*\w+){{0,5}}?\W*(?:{_PLACE})"
    explained = F.when(text.rlike(about) & ~text.rlike(dense), F.regexp_replace(text, about, " ")).otherwise(text)
    return F.when(text.rlike(r"[{\[<%$]|__|\*\|"), explained.rlike(_PLACE)).otherwise(False)


def is_filler(text: Column, low: Column) -> Column:
    latin = r"(?i)\b(?:(?:" + "|".join(LATIN) + rf")\b[\s,.;]*){{{LATIN_RUN}}}"
    # counts are exact, not open: an open repeat of a group costs stack for every turn in a long text
    # possessive, so a word that is not repeated is left at once
    again = r"\b(?!(?:" + "|".join(EMPHASIS) + r")\b)(\p{L}{2,}+)(?:\s+\1\b){4}"
    dummy = r"(?iu)(?<![\p{L}\p{N}])(test|xxx+|bla|blah|asdf|qwerty|tbd|todo|foo|dummy|text|n/a)(?:\s+\1){2}(?![\p{L}\p{N}])"
    return (
        F.when(_any(low, ["lorem", "ipsum", "dolor", "amet"]), text.rlike(latin)).otherwise(False)
        | low.rlike(again)
        | F.when(_any(low, ["test test", "xxx xxx", "bla bla", "blah blah", "asdf asdf", "qwerty qwerty", "tbd tbd", "todo todo", "foo foo", "dummy dummy", "text text", "n/a n/a", "xxxx"]), text.rlike(dummy)).otherwise(False)
        | F.when(
            _any(low, [" text", " content", " copy", " paragraph", " here", "to edit", "to add", "to change", "to enter", "add a", "type something", "replace ", "hier ", "geben sie", "blindtext", "mustertext", "platzhaltertext", "beispieltext", "aquí", "texto de", "текст", "заголовок"]),
            text.rlike(_phrases(FILLER)),
        ).otherwise(False)
    )


def is_error(text: Column, low: Column) -> Column:
    served = _B + "(?:" + "|".join([
        rf"(?:(?i:HTTP)[/ ]?[\d.]* )?(?:(?i:error) )?[45]\d\d\s*(?:[-–:]\s*)?{_REASON}(?:\s*$|\s*[\n\r.!<]|\s+(?-i:\p{{Lu}})|\s+(?i:nginx|apache|cloudflare|openresty|varnish|caddy|iis)\b)",
        rf"{_REASON}!",
        r"(?i:(?:http )?error\s+[45]\d\d)\.(?:\s|$)",
    ]) + ")|" + "|".join([
        rf"(?i:\bHTTP)[/ ]?[\d.]*\s+[45]\d\d:\s*{_REASON}",
        rf"<title>\s*[45]\d\d\s+{_REASON}",
        r"\"(?:code|status)\"\s*:\s*\"?[45]\d\d\b[^{}]{0,200}\"(?:error|message|title)\"|\"error\"\s*:\s*\{\s*\"code\"\s*:\s*[45]\d\d\b",
    ])
    return (
        F.when(text.contains("!") | text.rlike(r"[45]\d\d"), text.rlike(served)).otherwise(False)
        | F.when(
            _any(low, [
                "wrong", "sorry", "oops", "uh-oh", "oh no", "error", "exception", "upstream", "timed out", "refused", "reset by peer", "expired", "not found", "not be ", "not exist", "cannot be", "not respond", "n't ", "n’t ", "not available", "not handle", "not process", "not complete",
                "no longer", "is broken", "been moved", "been removed", "been deleted", "been blocked", "been suspended", "is down", "unavailable", "unreachable", "not accessible", "is available", "are available", "was found", "reachable", "denied", "forbidden", "do not have", "are not ", "unusual", "suspicious", "automated", "abnormal",
                "robot", "human", "checking", "in your ", "maintenance", "try again", "página", "seite ", "страница", "verweigert", "denegado", "доступ", "schiefgelaufen", "algo sal", "что-то",
            ]),
            text.rlike(_phrases(ERROR)),
        ).otherwise(False)
    )


def wants_scripts(text: Column, low: Column) -> Column:
    return F.when(_any(low, ["script", " js"]), text.rlike(_phrases(SCRIPTS)) | low.contains("<noscript>")).otherwise(False)


def with_residue(df: DataFrame, text: str, name: str = "residue") -> DataFrame:
    """``df`` plus ``name``: what kind of residue ``text`` is or contains, or null."""
    t, low = F.col("_text"), F.col("_low")
    wide = _any(F.col(text), ["  ", "\t", "\u00a0", "\u2009", "\u202f"])
    df = once(df.withColumn("_text", shown(F.when(wide, F.regexp_replace(F.col(text), "[ \\t\\u00a0\\u2009\\u202f]+", " ")).otherwise(F.col(text)))), "_text")
    df = once(df.withColumn("_low", F.lower(F.translate("_text", "\n\r", "  "))), "_low")
    kind = (
        F.when(wants_scripts(t, low), "scripts").when(is_error(t, low), "error").when(is_filler(t, low), "filler").when(has_place(t), "template")
    )
    return df.withColumn(name, kind).drop("_text", "_low")


def residue_records(items: DataFrame, entries: DataFrame, chunks: DataFrame, messages: DataFrame) -> DataFrame:
    """(``src``, ``row_key``) of every record of the four tables that should be left out."""

    def found(df: DataFrame, src: str, key: str, text: Column) -> DataFrame:
        rows = df.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("row_key"), text.alias("text"))
        return once(with_residue(rows, "text").select("row_key", "residue"), "residue").where("residue is not null").select(F.lit(src).alias("src"), "row_key").distinct()

    said = F.regexp_replace(F.col("text"), r"^(?:User|Assistant): ", "")
    return (
        found(items, "memory_items", "id", F.col("content"))
        .unionByName(found(entries, "memory_daily_entries", "id", F.col("content")))
        .unionByName(found(chunks, "session_index_chunks", "id", said))
        .unionByName(found(messages, "session_messages", "row_id", message_text(F.col("content"))))
    )
