"""Labelled findings that the secret scan learns from by default.

Each form is a label (1 a secret, 0 none), a kind of value, and the text it stands in. Values are made
from a hash of the form and a number, so there are as many different ones as wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Values made of each form.
PER_FORM = 40

#: Common words of prose, configuration and code, known whatever the corpus holds.
WORDS = (
    "about after again agent angle apple asset attribution author bank base battery bicycle black "
    "block blue bread bridge build button cache candle castle change charter check cheese client "
    "cloud coffee color config content copper correct count cover cricket data dealer debug default "
    "dragon east editor elephant engine error event example falcon field file filter final finger "
    "flower folder forest format friend garden general glass green ground guide guidelines hammer "
    "handler harbor history horse house image index input island jacket kernel kitchen label ladder "
    "language large left letter level library light list local magic main manager market master "
    "matrix member message meter model monkey morning mountain name network north number object ocean "
    "option orange output package page paper parser people pepper planet policy printer project "
    "purple rabbit range reader record release report request result river rocket sample schema "
    "school script season server service silver simple small source south spring square staple "
    "station stone storage street style summer sunshine system table template test text that their "
    "there ticket tiger time tower train travel update user value vector version village water west "
    "white window winter with world writer yellow"
)

#: (label, kind of value, text around it)
FORMS = [
    # Vendors' forms, wherever they stand.
    (1, "aws", "{}"),
    (1, "aws", "the account uses {} for uploads"),
    (1, "aws", "id,{},west"),
    (1, "github", "clone with {} today"),
    (1, "github", "https://host.example/?token={}"),
    (1, "github", '{"id":1,"token":"{}"}'),
    (1, "openai", "({})"),
    (1, "openai", "export KEY={}"),
    (1, "slack", "bot {} joined"),
    (1, "stripe", "charge with `{}`"),
    (1, "google", "maps?key={}"),
    (1, "gitlab", "remote: {}"),
    (1, "jwt", "Authorization: Bearer {}"),
    (1, "jwt", "cookie {};"),
    # Random values of names that say so.
    (1, "hex40", 'token = "{}"'),
    (1, "hex40", "access_token: {}"),
    (1, "hex32", "api_key={}"),
    (1, "hex32", "API-KEY: '{}'"),
    (1, "hex64", "client_secret = {}"),
    (1, "hex64", "SECRET_KEY='{}'"),
    (1, "mixed40", "aws_secret_access_key = {}"),
    (1, "mixed40", 'secret: "{}"'),
    (1, "mixed24", "accessToken: '{}'"),
    (1, "mixed24", "auth_token={}&page=2"),
    (1, "padded", "credential := {}"),
    (1, "padded", "secret = '{}'"),
    (1, "uuid", "api_key = {}"),
    (1, "uuid", 'client_secret="{}"'),
    # Passwords.
    (1, "two_words", "password: {}"),
    (1, "two_words", "password = '{}'"),
    (1, "three_words", "passwd={}"),
    (1, "word_digits", "password={}"),
    (1, "word_digits", 'the password is: password = "{}"'),
    (1, "word_signs", 'PASSWORD="{}"'),
    (1, "word_signs", "db_password: {}"),
    (1, "mixed12", "password = {}"),
    (1, "mixed12", '"passwd": "{}"'),
    (1, "mixed12", "secret='{}'"),
    # Random values of names that say something else, or of none.
    (0, "hex40", "commit {}"),
    (0, "hex40", "git checkout {}"),
    (0, "hex40", "fixed in {} by the release"),
    (0, "hex40", 'revision = "{}"'),
    (0, "hex64", "sha256:{}"),
    (0, "hex64", "sha256sum {} file"),
    (0, "hex64", "digest: {}"),
    (0, "hex32", "md5 = {}"),
    (0, "hex32", 'ETag: "{}"'),
    (0, "hex32", "https://host.example/page/{}"),
    (0, "hex64", "checksum={}"),
    (0, "uuid", "request {} done"),
    (0, "uuid", 'id: "{}"'),
    (0, "uuid", "uuid = {}"),
    (0, "uuid", "{}"),
    (0, "padded", 'integrity="sha384-{}"'),
    (0, "image", "data:image/png;base64,{}"),
    (0, "image", "src={}"),
    (0, "mixed24", "video?v={}"),
    (0, "mixed24", "cid: {}"),
    (0, "digits16", "card {} paid"),
    (0, "digits16", "{}"),
    (0, "digits16", "order = {}"),
    (0, "digits10", "auth_time: {}"),
    (0, "digits4", "max_tokens = {}"),
    (0, "digits4", "token_count: {}"),
    # Words, names and paths.
    (0, "three_words", "a {} here"),
    (0, "three_words", "{}"),
    (0, "three_words_upper", "and {} too"),
    (0, "slug", "see {} for more"),
    (0, "slug", "https://host.example/{}"),
    (0, "slug_year", "posts/{}"),
    (0, "slug_year", "{}"),
    (0, "slug_version", 'tokenizer = "{}"'),
    (0, "slug_version", "model: {}"),
    (0, "slug", 'author = "{}"'),
    (0, "slug", "authors: {}"),
    (0, "snake", "call {}() again"),
    (0, "snake", "from {} import all"),
    (0, "snake_upper", "set {} first"),
    (0, "camel", "new {}(input)"),
    (0, "path", "open {} now"),
    (0, "path", "/home/{}"),
    (0, "path", "file = '{}'"),
    (0, "path_digits", "cat {} end"),
    # Prose, references and settings after names that say secret.
    (0, "word", "the secret: {} left"),
    (0, "word", "this is the secret: {}"),
    (0, "word", "a password: {} of the house"),
    (0, "short_word", "the secret: {} left"),
    (0, "short_word", "password: {} may be long"),
    (0, "short_word", "token = {}"),
    (0, "word", "password: {}"),
    (0, "new_word", "password: {} by the form"),
    (0, "new_word", "the secret: {} there"),
    (0, "new_word", 'token = "{}"'),
    (0, "call", "password = {}"),
    (0, "call", "token={}"),
    (0, "variable", "secret: {}"),
    (0, "variable", 'api_key = "{}"'),
    (0, "placeholder", "password = {}"),
    (0, "placeholder", 'token: "{}"'),
    (0, "snake", "token = {}"),
    (0, "path", "secret_file: {}"),
    (0, "path", "credentials = '{}'"),
]


def _values(words: Column, seed: Column) -> dict[str, Column]:
    def digest(salt: str) -> Column:
        return F.sha2(F.concat(seed, F.lit(salt)), 256)

    def word(salt: str) -> Column:
        return F.get(words, F.pmod(F.xxhash64(seed, F.lit(salt)), F.size(words)).cast("int"))

    def mixed(salt: str) -> Column:
        both = F.unhex(F.concat(digest(salt), digest(f"{salt}2")))
        return F.translate(F.regexp_replace(F.base64(both), r"\s", ""), "+/=", "xY7")

    def prefixed(prefix: str, value: Column) -> Column:
        return F.concat(F.lit(prefix), value)

    def part(value: Column, length: int) -> Column:
        return F.left(value, F.lit(length))

    def joined(sign: str, *parts: Column) -> Column:
        return F.concat_ws(sign, *parts)

    digits = F.translate(digest("digits"), "abcdef", "135790")
    random = mixed("mixed")
    one, two, three, four = (word(n) for n in ("one", "two", "three", "four"))
    snake = joined("_", one, two, three)
    return {
        "aws": prefixed("AKIA", F.upper(part(random, 16))),
        "github": prefixed("ghp_", part(random, 36)),
        "openai": prefixed("sk-", part(random, 48)),
        "slack": prefixed("xoxb-", joined("-", part(digits, 12), part(random, 24))),
        "stripe": prefixed("sk_live_", part(random, 24)),
        "google": prefixed("AIza", part(random, 35)),
        "gitlab": prefixed("glpat-", part(random, 20)),
        "jwt": joined(".", prefixed("eyJ", part(random, 33)), prefixed("eyJ", part(mixed("b"), 60)), mixed("c")),
        "hex32": part(digest("hex"), 32),
        "hex40": part(digest("hex"), 40),
        "hex64": digest("hex"),
        "uuid": F.regexp_replace(
            part(digest("hex"), 32), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"
        ),
        "padded": F.base64(F.unhex(part(digest("hex"), 44))),
        "image": F.concat(F.lit("iVBORw0KGgo"), random, mixed("d"), F.lit("==")),
        "mixed12": part(random, 12),
        "mixed24": part(random, 24),
        "mixed40": part(random, 40),
        "digits4": part(digits, 4),
        "digits10": part(digits, 10),
        "digits16": part(digits, 16),
        "word": one,
        "short_word": part(one, 3),
        # Like a word that no dictionary holds.
        "new_word": F.concat(part(one, 4), F.right(two, F.lit(3))),
        "two_words": F.concat(one, two),
        "three_words": F.concat(one, two, three),
        "three_words_upper": F.upper(F.concat(one, two, three)),
        "word_digits": F.concat(one, part(digits, 4)),
        "word_signs": F.concat(F.initcap(one), F.lit("!"), part(digits, 2), F.lit("$"), part(two, 3)),
        "slug": joined("-", one, two, three),
        "slug_year": joined("-", one, two, three, prefixed("20", part(digits, 2))),
        "slug_version": joined("-", one, two, three, prefixed("v", part(digits, 1))),
        "snake": snake,
        "snake_upper": F.upper(snake),
        "camel": F.concat(F.initcap(one), F.initcap(two), F.initcap(three)),
        "path": joined("/", one, two, three, four),
        "path_digits": F.concat(joined("/", one, two, three), part(digits, 3), F.lit(".txt")),
        "call": F.concat(F.lit("get_"), one, F.lit('("'), F.upper(two), F.lit('")')),
        "variable": F.concat(F.lit("${"), F.upper(joined("_", one, two)), F.lit("}")),
        "placeholder": F.concat(F.lit("<your-"), one, F.lit(">")),
    }


def example_texts(spark: SparkSession, per_form: int = PER_FORM) -> DataFrame:
    """``(example, text)``: a text per form and number; ``example`` has its label and value.

    Built-in expressions over a range of numbers. The rows are the same in every run.
    """
    forms = F.array(
        *[
            F.struct(F.lit(float(label)).alias("label"), F.lit(kind).alias("kind"), F.lit(around).alias("around"))
            for label, kind, around in FORMS
        ]
    )
    rows = spark.range(per_form).select("id", F.posexplode(forms).alias("form", "of"))
    rows = rows.select("of.*", F.concat_ws(":", "form", "id").alias("seed"), F.split(F.lit(WORDS), " ").alias("words"))
    kinds = _values(F.col("words"), F.col("seed"))
    value = F.coalesce(*[F.when(F.col("kind") == kind, made) for kind, made in kinds.items()])
    rows = rows.select("label", "around", value.alias("value"))
    return rows.select(
        F.struct("label", "value").alias("example"),
        F.replace("around", F.lit("{}"), F.col("value")).alias("text"),
    )
