"""URL filter: suffix rules first, then logistic regression on hashed character n-grams of host and path.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged by the model alone; an
empty table gives no rows; repeated urls get the same verdict; of two equally long rules the first counts; very long urls are
judged by all of their n-grams; columns of the input beyond the id and the url are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .workspace import ship

BITS = 15
SIZES = (3, 4, 5)

# The rules of the contract, as verdict, host, path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The small labelled table that the model is trained on, as host and path.
BLOCKED = """
casino-royal.example.net /slots/free | www.casino.example.com /slots/jackpot | best-casino.example.org /bonus | blog.casino-win.example.net /en/12.html
online-poker.example.org /play/free-spins | poker-casino.example.com /bonus/win | slots-jackpot.example.net /casino/spins | bet-win.example.com /odds/bonus
sports-bet.example.org /bet/odds | www.bet-poker.example.net /win | lottery-win.example.com /jackpot/claim | lottery-winner.example.net /claim/prize
free-prize.example.org /claim/win | prize-claim.example.com /lottery | cheap-pills.example.com /buy/viagra | viagra-pills.example.net /order/cheap
free-viagra.example.org /buy/pills | pharma-pills.example.com /cheap/order | cheap-pharma.example.net /viagra | replica-watches.example.org /cheap/buy
fake-watches.example.com /replica/buy | adult-xxx.example.com /video/porn | xxx-porn.example.net /adult/free | adult-chat.example.org /cams/sex
hot-sex.example.com /cams/free | www.porn-video.example.net /xxx/adult | sex-cams.example.org /adult/chat | escort-adult.example.net /sex | escort-sex.example.com /hot
ads-track.example.com /click/banner | ads.example.net /banner/click?id | adserver.example.org /track/pixel.gif | track-click.example.com /redirect/ads
click-tracker.example.net /redirect | popup-ads.example.com /click/pop | banner-ads.example.org /track | pixel-track.example.net /ads/pixel.gif
spam-farm.example.org /links/spam | www.spam.example.net /win/free | link-farm.example.com /links/backlinks | seo-spam.example.net /backlinks
seo-links.example.org /backlinks/buy | spam-mail.example.com /links/unsubscribe | payday-loan.example.com /loan/apply | fast-loan.example.net /payday/cash
cash-loan.example.org /apply/payday | crypto-doubler.example.org /send/double | double-crypto.example.com /claim/cash | malware-host.example.com /payload.exe
phishing-login.example.net /account/verify | verify-account.example.com /login/phishing | account-login.example.org /verify/payload.exe | free-malware.example.net /download/crack.exe
warez-crack.example.org /keygen/download | keygen-crack.example.com /warez | torrent-warez.example.net /crack/keygen | torrent-porn.example.com /download/xxx
"""
ALLOWED = """
news.example.com /world/2024/article.html | www.news.example.org /article/politics | daily-news.example.net /world/article | local-news.example.com /city/article.html
blog.garden.example.org /posts/42 | garden.example.net /posts/plants | blog.travel.example.com /es/madrid | travel.example.org /posts/spain | www.travel-guide.example.net /guide/madrid
library.example.net /catalogue/books | www.library.example.org /catalogue/ | books.example.com /catalogue/fiction | shop.books.example.com /fiction/12
docs.example.com /en/guide | docs.example.org /guide/install | code.example.org /docs/readme | code.example.net /project/readme | project-docs.example.com /guide/project
weather.example.net /forecast/ | m.weather.example.com /forecast/city | university.example.org /research/papers | www.university.example.com /lectures/maths
maths.example.com /lectures/3.html | science.example.com /de/physik | science.example.org /research/physics | research.example.net /papers/2023 | school.example.net /fr/cours
www.school.example.org /lectures/history | history.example.org /en/timeline | history-museum.example.com /visit/timeline | museum.example.net /visit | art-museum.example.org /gallery/visit
art.example.com /gallery/2 | recipes.example.org /soup/lentil | www.recipes.example.net /bread/rye | bakery.example.net /about/bread | www.bakery.example.com /about
city-council.example.com /meetings | www.city.example.org /council/meetings | wiki.example.net /wiki/Graph | wiki.example.org /wiki/History | forum.example.org /thread/981
forum.garden.example.com /thread/plants | health.example.org /advice/sleep | health-advice.example.net /sleep/guide | mountain.example.net /routes/7 | www.mountain-routes.example.org /guide
radio.example.org /programme | radio-news.example.com /programme/2 | theatre.example.com /tickets | www.theatre.example.net /programme/tickets | sports.example.net /results/1
m.sports.example.org /results/city | music.example.com /albums | music.example.org /albums/reviews | railway.example.org /timetable | www.railway.example.net /timetable/city
data.example.net /sets/climate | climate.example.org /data/papers | film-reviews.example.com /reviews/12 | film.example.net /reviews/2024
"""


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null. Of two equally long ones, the first counts."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    cases = [F.when(_fits(host, path, h, p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ranked]
    return F.coalesce(*cases) if cases else F.lit(None).cast("struct<rule:string,verdict:string>")


def _grams(parts: Sequence[str], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Of all texts at once: the text that each character n-gram of its bytes between ^ and $ stands in, and the n-gram's bucket."""
    data = [b"^" + p.encode("utf-8", "surrogatepass") + b"$" for p in parts]
    values = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    sizes = np.array([len(d) for d in data])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(values))  # bytes up to the end of the text
    owner = np.repeat(np.arange(len(data)), sizes)
    owners, buckets = [], []
    for n in SIZES:
        h = np.full(max(len(values) - n + 1, 0), 0x811C9DC5 ^ (salt * 31 + n), np.uint32)
        for j in range(n):
            h = (h ^ values[j : len(h) + j]) * np.uint32(0x01000193)
        inside = left[: len(h)] >= n
        h = h[inside]
        owners.append(owner[: len(inside)][inside])
        buckets.append((((h ^ (h >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64))
    return np.concatenate(owners), np.concatenate(buckets)


def features(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (url, bucket) of both parts; the part is hashed with the n-gram."""
    one, two = _grams(hosts, 1), _grams(paths, 2)
    found = np.unique(np.concatenate([one[0], two[0]]) << BITS | np.concatenate([one[1], two[1]]))
    return found >> BITS, found & ((1 << BITS) - 1)


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def probabilities(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Of block, from 0 to 1, by url."""
        url, bucket = features(hosts, paths)
        count = np.bincount(url, minlength=len(hosts))
        z = self.bias + np.bincount(url, self.weights[bucket], len(hosts)) / np.sqrt(np.maximum(count, 1))
        return 1 / (1 + np.exp(-z))


def labelled() -> list[tuple[str, str, int]]:
    rows = []
    for label, table in ((1, BLOCKED), (0, ALLOWED)):
        for entry in table.replace("\n", " | ").split(" | "):
            if entry.strip():
                host, path = entry.split()
                rows.append((host, path, label))
    return rows


def train(rows: Sequence[tuple[str, str, int]], epochs: int = 60, rate: float = 0.5, decay: float = 1e-4) -> UrlModel:
    """Stochastic gradient descent in a fixed order; the same rows give the same model."""
    weights, bias = np.zeros(1 << BITS), -1.0  # without evidence, allow
    rng = np.random.default_rng(7)
    data = [(features([h], [p])[1], y) for h, p, y in rows]
    for epoch in range(epochs):
        step = rate / (1 + 0.05 * epoch)
        for i in rng.permutation(len(data)):
            own, y = data[i]
            scale = 1 / np.sqrt(max(len(own), 1))
            error = 1 / (1 + np.exp(-(bias + weights[own].sum() * scale))) - y
            weights[own] -= step * (error * scale + decay * weights[own])
            bias -= 0.1 * step * error
    return UrlModel(weights, bias)


@lru_cache(1)
def default_model() -> UrlModel:
    return train(labelled())


def block_probability(model: UrlModel):
    """A function of host, path and whether the url is to be judged at all; null where not."""
    weights, bias = model.weights.astype(np.float32), model.bias

    @F.pandas_udf(DoubleType())
    def score(hosts, paths, open_):
        import pandas as pd

        out = np.full(len(hosts), np.nan)
        at = np.flatnonzero(open_.to_numpy(bool))
        for begin in range(0, len(at), 4096):
            own = at[begin : begin + 4096]
            out[own] = UrlModel(weights, bias).probabilities(hosts.iloc[own].tolist(), paths.iloc[own].tolist())
        return pd.Series(out)

    return score


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, model: UrlModel | None = None, threshold: float = 0.5) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row: score is the model's probability of block, null where a rule decides."""
    ship(pages.sparkSession)
    score = block_probability(model or default_model())
    split = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    judged = split.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("score", score("host", "path", F.col("hit").isNull()))
    verdict = F.coalesce(F.col("hit.verdict"), F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return judged.select(id_col, "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), F.when(F.col("hit").isNull(), F.col("score")).alias("score"))
