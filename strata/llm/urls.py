"""URL filter: site rules first, then logistic regression on character n-grams of host and path.

Rules and the labelled URLs are small parameter lists; the model (a vector of
fixed size) is fitted on the driver from the labelled URLs alone.  Parsing and
rules are column expressions; scoring is one pass over the rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import LOWER, ship

#: (verdict, rule): a rule is a host and the start of a path.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))

_GOOD = ("news", "library", "museum", "recipes", "garden", "science", "history", "school", "weather", "music", "travel",
         "books", "sports", "health", "law", "maps", "art", "physics", "village", "theatre", "therapy", "nation", "thunder", "ration",
         "open-source", "self-help", "high-school", "city-library", "fair-trade", "first-aid", "north-sea", "book-club", "e-learning",
         "wind-power", "dairy-farm", "food-and-drink", "south-east", "human-being", "bed-linen", "home-made", "how-to", "re-use", "town-hall")
#: Ordinary words, so that a plain unknown host is no spam.
_PLAIN = """water mountain river forest bridge station market kitchen window table paper letter number story family mother father brother sister
child teacher student doctor engineer farmer sailor driver painter singer writer reader morning evening summer winter autumn spring
north south east west street avenue corner square castle tower church temple palace island ocean harbour beach desert valley hill
stone metal wood glass leather cotton silk wool bread butter cheese coffee sugar salt pepper apple orange lemon cherry tomato potato
horse cattle sheep rabbit tiger lion eagle falcon robin salmon whale dolphin turtle spider planet comet galaxy rocket satellite
machine motor wheel railway airport bicycle theory method research journal archive edition lecture university college institute
government council ministry parliament election justice treaty union nation region county district wikipedia britannica github python
apache mozilla debian ubuntu linux stackoverflow bbc guardian times tribune herald gazette reuters thinking other weather there whether
nothing something anything action section station motion potion lotion fiction relation rotation then when while which where the and
standard thousand handle candle sandal bandage kindergarten bundle under thunder wonder winner dinner inner""".split()
_BAD = ("pills-online", "buy-pills", "discount-viagra", "viagra-online", "bet-casino", "casino-bonus", "casino-royal", "live-bets", "bets-now",
        "win-prize", "win-big", "poker-bonus", "online-poker", "slots-jackpot", "mega-slots", "slots88", "adult-cams", "adult-video", "porn-tube", "freeporn",
        "xxx-tube", "hot-xxx", "live-cams", "hot-dating", "spam-links", "spam-mail", "link-farm", "track-ads", "ads-server", "click-ads", "pop-track",
        "loan-fast", "payday-loan", "cheap-meds", "cheap-watches", "replica-watch", "crypto-double", "free-crypto", "free-spins", "phish-bank", "secure-phish",
        "verify-login", "login-alert", "free-prizes", "viagra4u", "best-viagra", "cialis-shop", "slots-online", "slots4u", "xxx-porn", "adult-films",
        "spam-host", "spam-list", "content-farm", "casino-slots", "win-cash")
_PATHS = ("/", "/en/12", "/fr/34.html", "/de/56/", "/es/78?page=2&ref=x")
_GOOD_PATHS = ("/recipes/apple-pie", "/history/roman-art", "/articles/how-to-plant-a-tree", "/about-us/contact", "/science/well-known-facts", "/books/list.html",
               "/help/sign-in", "/travel/north-sea", "/opening-hours", "/sports/results/77", "/school/maths/9", "/music/live-concert",
               "/wiki/Physics", "/news/local/story-41", "/world/asia/report-9", "/questions/12/sorting-a-list")
_BAD_PATHS = ("/porn/xxx-videos", "/freeporn/tube", "/xxx/live-cams/5", "/casino/bonus-spins", "/casino/poker", "/bets/live-bets/7", "/pills/buy-pills", "/buy/viagra",
              "/slots/jackpot", "/win-prize/click", "/adult/dating", "/ads/track-ads", "/spam/links", "/cheap-meds", "/payday-loan", "/phish/verify-login",
              "/free-spins", "/replica-watch/3")


def labelled_urls() -> list[tuple[str, int]]:
    """The default labelled table: (url, 1 for block); a spam host or a spam path makes a url spam.

    The spam hosts of the given tables are not in it, so that they measure the recall on unseen names.
    """
    out = []
    for bad, names in enumerate(([*_GOOD, *_PLAIN], _BAD)):
        for i, name in enumerate(names):
            host = ("", "www.", "blog.", "m.")[i % 4] + name + ".example." + ("com", "org", "net")[i % 3]
            known = bad or i < len(_GOOD)
            out += [(f"https://{host}{path}", bad) for path in (_PATHS if known else _PATHS[i % 5:][:2])]
            out.append((f"http://{name}.{('com', 'org', 'net')[i % 3]}/", bad))
            out.append((f"https://{host}{_GOOD_PATHS[i % len(_GOOD_PATHS)]}", bad))
            spam = 3 if bad else 1 if known or i % 2 else 0
            out += [(f"https://{host}{_BAD_PATHS[(i + 7 * k) % len(_BAD_PATHS)]}", 1) for k in range(spam)]
    return out


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule (null if none): its host or a subdomain, and a path that starts as the rule's.

    Of equal rules the first of the list counts.
    """
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        site, slash, start = rule.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


class UrlModel:
    """Logistic regression on hashed 3- to 5-grams of host and path, kept apart by a mark."""

    def __init__(self, bits: int = 14, sizes=(3, 4, 5)):
        self.bits, self.sizes = bits, sizes
        self.weights, self.bias = np.zeros(1 << bits), 0.0

    def slots(self, host: str, path: str) -> np.ndarray:
        found = set()
        for mark, part in ((b"h", host), (b"p", path)):
            raw = b"^" + part.encode().translate(LOWER) + b"$"
            for n in self.sizes:
                found |= {zlib.crc32(mark + raw[i:i + n]) & ((1 << self.bits) - 1) for i in range(len(raw) - n + 1)}
        return np.fromiter(sorted(found), np.int64, len(found))

    def score(self, host: str, path: str) -> float:
        at = self.slots(host, path)
        z = self.weights[at].sum() / max(len(at), 1) ** 0.5 + self.bias
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def fit(self, rows, steps: int = 300, rate: float = 1.0, decay: float = 1e-3) -> UrlModel:
        """``rows``: (host, path, 1 for block)."""
        if not rows:
            return self
        x = np.zeros((len(rows), 1 << self.bits), np.float32)
        for i, (host, path, _) in enumerate(rows):
            at = self.slots(host, path)
            x[i, at] = max(len(at), 1) ** -0.5
        y = np.array([r[2] for r in rows], np.float32)
        used = np.flatnonzero(x.any(0))
        x, w, b = x[:, used], np.zeros(len(used), np.float32), 0.0
        for _ in range(steps):
            off = 1 / (1 + np.exp(-(x @ w + b))) - y
            w -= rate * 10 * (off @ x / len(y) + decay * w)
            b -= rate * off.mean()
        self.weights[used], self.bias = w, float(b)
        return self


def _parse(url: str) -> tuple[str, str]:
    _, sep, rest = url.partition("://")
    if not sep:
        return "", ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    tail = rest[cut:]
    return (rest[:cut].encode().translate(LOWER).decode(),
            tail[:min((tail.find(c) for c in "?#" if c in tail), default=len(tail))])


def train(labelled=None) -> UrlModel:
    """A model from a small labelled table of ``(url, 1 for block)``."""
    return UrlModel().fit([(*_parse(url), bad) for url, bad in (labelled_urls() if labelled is None else labelled)])


def _scores(model):
    def run(batches):
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([model.score(h, p) for h, p in pairs], pa.float64())], [*batch.schema.names, "score"])
    return run


def filter_urls(df: DataFrame, model: UrlModel | None = None, rules=RULES, id_col: str = "page_id", url_col: str = "url",
                threshold: float = 0.5) -> DataFrame:
    """``id_col, host, path, rule, verdict, score`` of every row.

    ``verdict`` is the rule's, else ``block`` where the model's score reaches ``threshold``, else ``allow``.
    A null url, or one without ``://``, has empty host and path and is judged by the model alone.
    """
    ship(df.sparkSession)
    model = model or train()
    kind = df.schema[id_col].dataType.simpleString()
    parsed = df.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    scored = parsed.mapInArrow(_scores(model), f"id {kind}, host string, path string, score double")
    verdicts = F.lit(None).cast("string")
    for verdict, rule in reversed(rules):
        verdicts = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(verdicts)
    by_model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return (scored.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
            .withColumn("verdict", F.coalesce(verdicts, by_model))
            .select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "score"))
