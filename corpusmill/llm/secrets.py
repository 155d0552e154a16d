"""Secret scans: candidates by pattern, false positives removed by a random forest.

DataFrame functions only, training included.  A candidate is a run of key characters within a white-space
word, cut at every '=' but padding at its end.  It has at least SHORTEST characters and a digit, or is
announced: the value of an assignment whose name says secret (password: ..., token=..., the password is: ...), what
follows such a name and `is` if it has a digit or a mark, what follows `Bearer`, or the password in an address
(scheme://user:...@host).  An announced one may be of any length (after Bearer, SHORTEST) and have other marks too.  Its features are its length, its character transitions, the part of it that
dictionary fragments cover, what looks like a path, the makes of known keys, and the words beside it.  The
forest is fitted on findings in LABELLED texts made by a rule from numbers (keys of several makes beside words
that announce them, or bare with their make's prefix; digests, identifiers, paths, links, numbers, code and
placeholders), found as a scan finds them, and is applied as nested conditions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import forest
from corpusmill.llm.store import fresh_name

SHORTEST = 16
#: labelled texts whose findings the forest is fitted on, and the least score of a secret
LABELLED, SECRET = 3000, 0.5
_SPACE = r"[\x20\x09-\x0D]+"
_KEY = "A-Za-z0-9_+/.-"
_PADDING = f"(?:={{1,2}}(?![{_KEY}=]))?"
_RUN = f"[{_KEY}]{{16,}}{_PADDING}"

#: Words that announce a secret, fragments of ordinary words, and marks of placeholders.
KEYWORDS = "\\bkey\\b|token|secret|passw|pwd|apikey|api_key|api-key|auth|bearer|credential|private|access_key|client_key"
FRAGMENTS = "the|and|ing|tion|ment|that|this|with|from|have|file|name|user|data|path|home|page|index|image|version|release|test|example|mail|html|http|www|com|org|net|src|lib|main|config|report|number|order|chapter|section|article|document|build|commit|session|request|line|text|table|list|value|string|object|class|date|time|abstract|access|account|action|active|address|admin|after|all|before|block|body|book|button|call|center|change|check|client|code|color|column|content|control|copy|count|create|current|custom|default|delete|detail|device|display|down|edit|element|email|error|event|field|filter|find|first|folder|font|for|form|format|frame|function|global|group|head|height|help|hidden|icon|info|inner|input|item|join|label|last|layout|left|level|link|load|local|lock|long|make|map|match|menu|message|method|mode|model|module|new|next|node|note|open|option|outer|output|over|package|panel|parent|part|password|point|port|post|print|process|profile|project|public|query|read|record|remove|render|reply|result|right|root|row|save|screen|script|search|select|send|server|service|set|show|side|size|sort|source|space|start|state|status|step|style|system|tag|target|task|template|theme"

#: Pairs of letters that follow each other often in English.
PAIRS = "th|he|in|er|an|re|on|at|en|nd|ti|es|or|te|of|ed|is|it|al|ar|st|to|nt|ng|se|ha|as|ou|io|le|ve|co|me|de|hi|ri|ro|ic|ne|ea|ra|ce|li|ch|ll|be|ma|si|om|ur|ca|el|ta|la|ns|di|fo|ho|pe|ec|pr|no|ct|us|ac|ot|il|tr|ly|nc|et|ut|ss|so|rs|un|lo|wa|ge|ie|wh|ee|wi|em|ad|ol|rt|po|we|na|ul|ni|ts|mo|ow|pa|im|mi|ai|sh|ir|su|id|os|iv|ia|am|fi|ci|vi|pl|ig|tu|ev|ld|ry|mp|fe|bl|ab|gh|ty|op|wo|sa|ay|ex|ke|ui|fr|oo|av|ag|if|ap|gr|od|bo|sp|rd|do|uc|bu|ei|ov|by|rm|ep|tt|oc"
PLACEHOLDERS = "example|sample|dummy|placeholder|changeme|your|xxxx|0000|1234567|abcdef"

#: Names whose assigned value is a candidate whatever it is, first characters of known makes of keys, and what stands for a value or refers to one.
NAMES = "token|secret|pass(?:word|wd|phrase)|pwd|api[_-]?key|auth|bearer|credentials?|(?:private|access|client|secret)[_-]?key"
MAKES = "gh[pousr]_|github_pat_|glpat-|[sr]k_(?:live|test)_|xox[abeprs]-|A[KS]IA[A-Z0-9]{12}|AIza|npm_|pypi-|hf_|SG[.]|eyJ[A-Za-z0-9]"
REFERENCES = "(?:true|false|yes|no|none|null|nil|undefined|required|optional|str|string|int|integer|bool|boolean|number|any|empty|enabled|disabled|missing|invalid|expired|unknown|basic|bearer|password|passwd|token|secret|auth|key|value|the|an?|is|to|in|for|see|not|and|or|if|it|this|your|new|set|get|use)[.,;:!?*-]*$|(?:os|self|this|process|config|settings|env|args|options|params|request|req|ctx)[.]|.*(?:getenv|environ)|[^A-Za-z0-9]*$"
_ASSIGN = f"(?i:{NAMES})(?:[_-][A-Za-z0-9_-]{{0,24}})?[\"'`]?[]]?"
_ANNOUNCED = _ASSIGN + "(?:\\s+is)?\\s*[:=]{1,3}>?\\s*[\"'`]?$"
#: what announces a value without a sign, a value that such prose may announce, and what stands before a password in an address
_SAID, _BEARER, _TELLING = f"(?i:{NAMES})\\s+is\\s+[\"'`]?$", "(?i:\\bbearer)\\s+[\"'`]?$", "[0-9!@#$%^*_]"
_USER = "://[^\\s:/@]{1,64}:"
_LAST = f"{_KEY[:-2]}!@#$%^*~?="
_ANY = f"(?:[{_LAST}-]|[.:](?=[{_LAST}.:-]*[{_LAST}-]))"
_VALUE = f"(?![$]){_ANY}+"
#: (what is skipped, value): in any word, and in one that follows an announcement
_ADDRESS = f"(?<={_USER})[^\\s/@]{{1,256}}(?=@)"
_FOUND = f"(?s)(.*?)({_ADDRESS}|(?<={_ASSIGN}[:=]{{1,3}}>?[\"'`]?){_VALUE}|{_RUN})"
_NEXT = f"(?s)(.*?)((?<=^[\"'`]?){_VALUE}|(?<={_ASSIGN}[:=]{{1,3}}>?[\"'`]?){_VALUE}|{_RUN})"
_HAS = f"[{_KEY}=]{{16}}|{_ASSIGN}(?:\\s+is)?\\s*[:=]|{_USER}[^\\s/@]{{1,256}}@"
_SAYS = f"{_HAS}|(?i:{NAMES})\\s+is\\s"

FEATURES = ("length", "digits", "transitions", "distinct", "dictionary", "separators", "path", "keyword", "assigned", "placeholder", "hex", "make", "reference", "lower", "case", "letters", "pairs", "consonants", "credential", "said")


def _of_words(words: Column) -> Column:
    """(word_no, value, before) of each candidate; before holds the two words before its own and what precedes it there."""
    none = F.array().cast("array<struct<word_no:bigint,value:string,before:string>>")

    def found(w, i):
        near = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1), F.lit(""))

        def of(pattern):
            # held as an element, so that the patterns run once a word
            parts = F.array(F.struct(*(F.regexp_extract_all(w, F.lit(pattern), F.lit(k)).alias(c) for k, c in ((1, "skipped"), (2, "values")))))
            return F.flatten(F.transform(parts, lambda p: F.filter(F.transform(p["values"], lambda v, k: one(p, v, k)), listed)))

        def one(p, v, k):
            behind = F.zip_with(F.slice(p["skipped"], 1, k), F.slice(p["values"], 1, k), lambda a, b: F.concat(a, b))
            return F.struct(i.cast("long").alias("word_no"), v.alias("value"), F.concat(near, F.array_join(behind, ""), F.get(p["skipped"], k)).alias("before"))

        def listed(c):
            long, before = F.length(c["value"]) >= SHORTEST, c["before"]
            said = (before.rlike(_SAID) & c["value"].rlike(_TELLING)) | (long & before.rlike(_BEARER))
            return (long & c["value"].rlike("[0-9]")) | before.rlike(_ANNOUNCED) | before.rlike(_USER + "$") | said

        last = F.concat_ws(" ", F.get(words, i - 2), F.get(words, i - 1))
        signed = F.get(words, i - 1).rlike("[:=]>?[\"'`]?$") & last.rlike(_ANNOUNCED)
        # the word before is looked at first, as few are `is` or `bearer`
        told = F.lower(F.get(words, i - 1)).isin("is", "bearer") & F.concat(last, F.lit(" ")).rlike(f"{_SAID}|{_BEARER}")
        return F.when((i > 0) & (signed | told), of(_NEXT)).when(((F.length(w) >= SHORTEST) | w.rlike("[:=]")) & w.rlike(_HAS), of(_FOUND)).otherwise(none)

    return F.flatten(F.transform(words, found))


def _candidates(words: Column) -> Column:
    """_of_words, with the words held as an element, so that a filter moved below their column doesn't cut the text for every word anew."""
    return F.flatten(F.transform(F.array(words), _of_words))


def features(value: Column, before: Column) -> list[Column]:
    """FEATURES of a candidate, as doubles."""
    n = F.length(value).cast("double")
    low, near = F.lower(value), F.lower(before)
    share = lambda pattern: F.length(F.regexp_replace(value, f"[^{pattern}]", "")) / n
    turns = F.regexp_count(value, F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])"))
    return [
        n,
        share("0-9"),
        turns / n,
        F.size(F.array_distinct(F.split(value, ""))) / F.least(n, F.lit(40.0)),
        1 - F.length(F.regexp_replace(low, FRAGMENTS, "")) / n,
        share("._/-"),
        (value.contains("/") | near.rlike(r"[/\\]\s*$|://|www\.|@\s*$")).cast("double"),
        near.rlike(KEYWORDS).cast("double"),
        near.rlike(r"[=:]\s*[\"'`]?\s*$").cast("double"),
        low.rlike(PLACEHOLDERS).cast("double"),
        low.rlike("^[0-9a-f]+$").cast("double"),
        value.rlike(f"^(?:{MAKES})").cast("double"),
        low.rlike(f"^(?:{REFERENCES})").cast("double"),
        share("a-z"),
        # single kinds of character transitions, and how many of those between letters are a language's
        F.regexp_count(value, F.lit("(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[a-z])")) / n,
        F.regexp_count(value, F.lit("(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])")) / n,
        F.coalesce(F.regexp_count(low, F.lit(f"(?={PAIRS})")) / F.nullif(F.regexp_count(low, F.lit("(?=[a-z]{2})")), F.lit(0)), F.lit(0.0)),
        F.regexp_count(low, F.lit("(?=[bcdfghjklmnpqrstvwxz]{4})")) / n,
        near.rlike(_USER + "$").cast("double"),
        near.rlike(f"{_SAID}|{_BEARER}").cast("double"),
    ]


def labelled(spark: SparkSession, rows: int = LABELLED) -> DataFrame:
    """(id, value, before, secret): the candidates that a scan finds in texts made from the numbers 0 to rows, the same on every run."""
    digest = F.sha2(F.concat(F.lit("finding"), F.col("id").cast("string")), 512)
    packed = F.base64(F.unhex(digest))
    key = F.regexp_replace(packed, "[+/=]", "")
    number = lambda salt, n: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    pick = lambda options, salt: F.element_at(F.array(*map(F.lit, options)), number(salt, len(options)) + 1)
    size = number(3, 3)
    hexes = F.substring(digest, F.lit(1), F.element_at(F.array(F.lit(32), F.lit(40), F.lit(64)), size + 1))
    keys = F.substring(key, F.lit(1), size * 8 + 24)
    upper = F.substring(F.upper(key), F.lit(1), F.lit(16))
    names = ["token", "secret", "password", "api_key", "auth_token", "client_secret", "access_key", "bearer"]
    spaced = F.concat(pick(["the ", "set ", "use ", "", "export "], 1), pick([*names, "Bearer", "key"], 2), pick([' = "', " = ", ": ", ' : "', " ", " = '", " is ", " is: "], 4))
    joined = F.concat(pick(["", "export ", "run --", "curl https://www.site.com/path/list?", "docker run -e ", "{\"", "https://api.site.org/v1/?page=2&"], 9), pick([*names, "AWS_SECRET_ACCESS_KEY", "GITHUB_TOKEN", "DB_PASSWORD", "apikey"], 10), pick(["=", "=", "=\"", ":", "\":\"", "='"], 11))
    said = F.when(number(12, 2) == 0, spaced).otherwise(joined)
    names_value = F.when(number(12, 2) == 0, F.concat(pick(["the ", "set ", "use ", ""], 1), pick(names, 2), pick([' = "', " = ", ": ", ' : "', " is ", " is: "], 4))).when((number(23, 3) == 0) & (F.pmod(F.col("id"), F.lit(24)) < 20), pick(["postgres://app:", "mysql://root:", "https://me:", "amqp://worker1:"], 24)).otherwise(joined)
    plain = pick(["the ", "see the ", "of a ", "in that ", "and ", "commit ", "version ", "id: ", "file = ", "sha256: ", "build=", "order ", "etag=", "--rev=", "integrity=", "https://www.site.com/list?id=", "src="], 5)
    bare = pick(["", "the ", "see ", "in that ", "and ", "key ", "id: ", "with ", "x=", "value = ", "https://www.site.com/list?k="], 13)
    kind = F.pmod(F.col("id"), F.lit(24))
    word = pick(["thingation", "documentary", "reportersection", "configuration", "userrelease", "imageversion", "ordinarythings"], 6)
    name = pick(["sunshine", "hunter", "dragon", "monkey", "qwerty", "letmein", "summer", "zxcvbn", "iloveyou", "correcthorse", "trustno", "football", "princess", "shadow"], 14)
    digits = F.substring(F.regexp_replace(F.conv(F.substring(digest, 1, 15), 16, 10), "-", ""), 1, 18)
    uuid = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.substring(digest, 13, 4), F.substring(digest, 17, 4), F.substring(digest, 21, 12))
    make = pick(["ghp_", "gho_", "sk_live_", "sk_test_", "xoxb-", "glpat-", "npm_", "hf_", "AKIA", "ASIA"], 7)
    made = F.concat(make, F.when(make.endswith("IA"), upper).otherwise(keys))
    short = (
        F.when(number(15, 5) == 0, F.concat(name, F.substring(digits, F.lit(1), number(16, 4) + 1)))
        .when(number(15, 5) == 1, F.concat(F.initcap(name), pick(["!", "@", "#", "_", "$"], 17), F.substring(digits, F.lit(1), number(16, 4))))
        .when(number(15, 5) == 2, F.substring(F.regexp_replace(key, "[0-9]", ""), F.lit(1), number(16, 12) + 6))
        .when(number(15, 5) == 3, F.substring(key, F.lit(1), number(16, 9) + 6))
        .otherwise(F.concat(name, pick(["", "", "-", ".", "_"], 18), pick(["battery", "staple", "monkey", "", "tiger", "winter", "castle"], 19)))
    )
    reference = pick(["true", "false", "none", "null", "required", "optional", "string", "str,", "os.environ", "self.token", "process.env.TOKEN", "config.secret", "the", "a", "is", "password", "expired", "invalid.", "getenv", "missing", "enabled", "*****", "None", "args.password", "settings.SECRET_KEY"], 20)
    value = (
        F.when(kind < 3, hexes)
        .when(kind < 5, keys)
        .when(kind < 7, made)
        .when(kind == 7, F.substring(packed, 1, 44))
        .when(kind == 8, F.concat(F.substring(packed, 1, 42), F.lit("==")))
        .when(kind < 11, short)
        .when(kind < 14, hexes)
        .when(kind == 14, F.concat(word, F.substring(digits, 1, 3), F.lit("."), word, F.lit(".com")))
        .when(kind == 15, F.concat_ws("/", F.lit("home"), word, F.lit("src"), F.concat(F.substring(digest, 1, 6), F.lit(".html"))))
        .when(kind == 16, F.concat(digits, F.lit("0")))
        .when(kind == 17, uuid)
        .when(kind == 18, F.concat(word, word, F.substring(digits, 1, 2)))
        .when(kind == 19, pick(["YOUR_API_KEY_12345", "xxxxxxxxxxxxxxxx0000", "example-token-123456", "changeme_0000000000", "1234567890abcdef1234", "changeme", "your_password", "xxxx", "example"], 8))
        .when(kind < 22, reference)
        .when(kind == 22, F.when(number(21, 2) == 0, packed).otherwise(F.concat(pick(["sha512-", "sha256-", "", "data/"], 22), packed)))
        .otherwise(F.concat_ws("-", F.lit("2024"), word, F.substring(digits, 1, 2), word))
    )
    before = F.when((kind == 6), bare).when((kind < 9), said).when((kind < 11) | ((kind >= 19) & (kind < 22)), names_value).otherwise(plain)
    secret = kind < 11
    closing = F.when(before.rlike(_USER + "$"), "@db.site.org:5432/main").when(before.endswith('"'), '"').when(before.endswith("'"), "'").otherwise("")
    texts = spark.range(rows).select("id", value.alias("planted"), secret.alias("secret"), F.concat(before, value, closing).alias("text"))
    found = texts.withColumn("words", F.split("text", _SPACE)).select("id", "planted", "secret", F.explode(_candidates(F.col("words"))).alias("c"))
    return found.select("id", "c.value", "c.before", (F.col("secret") & (F.col("c.value") == F.col("planted"))).cast("double").alias("secret"))


def fit(spark: SparkSession) -> list:
    """The forest. Only the labelled findings' features, a fixed number of rows, reach the driver."""
    found = labelled(spark).select("id", F.array(*features(F.col("value"), F.col("before"))).alias("x"), "secret").orderBy("id", "x").collect()
    return forest.fit(np.array([r.x for r in found]), np.array([r.secret for r in found]))


def with_findings(df: DataFrame, trees: list, text: str = "text", out: str = "findings") -> DataFrame:
    """df with an array of (word_no, value, before, score, secret) of its candidates, in order. Null and empty texts have none."""
    score = lambda c: forest.expression(trees, features(c["value"], c["before"]))
    none = F.array().cast("array<struct<word_no:bigint,value:string,before:string>>")
    words = F.when(F.col(text).rlike(f"{_SAYS}|(?i:bearer)\\s"), F.split(text, _SPACE))
    held, cand = fresh_name(f"{out}_words", df.columns), fresh_name(f"{out}_candidates", df.columns)
    rows = df.withColumn(held, words)
    rows = rows.withColumn(cand, F.when(F.col(held).isNotNull(), _candidates(F.col(held))).otherwise(none)).drop(held)
    scored = F.transform(F.transform(cand, lambda c: F.struct(c["word_no"], c["value"], c["before"], score(c).alias("score"))), lambda c: F.struct(c["word_no"], c["value"], c["before"], c["score"], (c["score"] >= SECRET).alias("secret")))
    return rows.withColumn(out, scored).drop(cand)


def secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a candidate: doc_id, finding (from 0, in order), word_no, length, value_sha256, score, is_secret.

    The values themselves are not put out.  word_no counts white-space words from 0, after the empty one
    where a text begins with white space.  Documents without a candidate, null and empty texts give no row;
    rows that repeat give their findings each; other columns are not carried; an empty table gives an
    empty table.
    """
    found = with_findings(df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), fit(df.sparkSession))
    rows = found.select("doc_id", F.posexplode("findings").alias("finding", "f"))
    return rows.select("doc_id", F.col("finding").cast("long").alias("finding"), "f.word_no", F.length("f.value").cast("long").alias("length"), F.sha2("f.value", 256).alias("value_sha256"), "f.score", F.col("f.secret").alias("is_secret"))


def redacted(df: DataFrame, text: str = "text", mark: str = "[secret]", length: str | None = None) -> DataFrame:
    """df with every secret's value in the text replaced by mark, wherever it stands (a value of under SHORTEST characters only where it isn't part of a longer run), and the column `length`, if it is there, set to the text's length where that changed; all rows and columns stay."""
    out = fresh_name("findings", df.columns)
    rows = with_findings(df, fit(df.sparkSession), text, out)
    found = F.filter(out, lambda f: f["secret"])

    def hide(t, f):
        alone = F.concat(F.lit(r"(?<![A-Za-z0-9_])\Q"), f["value"], F.lit(r"\E(?![A-Za-z0-9_])"))
        return F.when(F.length(f["value"]) >= SHORTEST, F.replace(t, f["value"], F.lit(mark))).otherwise(F.regexp_replace(t, alone, F.lit(mark.replace("\\", r"\\").replace("$", r"\$"))))

    hidden = F.when(F.size(found) > 0, F.aggregate(found, F.col(text), hide)).otherwise(F.col(text))
    rows = rows.withColumn(text, hidden)
    if length in df.columns:
        rows = rows.withColumn(length, F.when(F.size(found) > 0, F.length(text)).otherwise(F.col(length)).cast(df.schema[length].dataType))
    return rows.select(*df.columns)
