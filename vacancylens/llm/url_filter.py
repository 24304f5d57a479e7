"""URL filter: logistic regression on hashed character n-grams, below a list of rules."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Batches, in_arrow, read, to_batch

# Host and path of a url; both empty without "://".
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))

# The small labelled table: site names by kind, to block (1) and to allow (0).  It is written from what such
# sites are called, without looking at any table this library is run on.
_BLOCKED_NAMES = """
casino-bonus grand-casino vegas-slots slot-machines-live roulette-king blackjack-table jackpot-city betting-tips-vip
sportsbook-odds bingo-cash poker-room-pro lottery-winners gambling-club baccarat-online instant-payout
viagra-online cialis-generic cheap-meds-shop diet-pills-now weight-loss-miracle pharmacy-without-prescription
steroids-for-sale xanax-order tramadol-express male-enhancement hair-growth-secret
xxx-videos porn-hd sex-chat-live naked-girls adult-dating hot-singles escorts-tonight webcam-strip milf-tubes
hentai-gallery nude-teens erotic-cams
click-tracker ad-network-serve banner-exchange popunder-media traffic-boost pixel-sync adserving-cdn
retarget-clicks pay-per-click-bid affiliate-offers
buy-backlinks seo-rank-fast link-exchange-hub bulk-email-blast guest-posts-cheap article-spinner-tool
payday-loan-fast instant-credit-approval no-credit-check-cash debt-wiped forex-signals-profit binary-options-trade
crypto-doubler bitcoin-giveaway get-rich-quick easy-money-home
replica-rolex fake-designer-bags discount-handbags-outlet knockoff-sneakers louis-outlet-sale
warez-download keygen-serials cracked-software torrent-movies-free nulled-scripts full-version-crack
account-verify-login secure-update-billing paypal-confirm wallet-recover-support password-reset-alert
you-won-iphone free-gift-card-claim survey-rewards prize-draw-winner lucky-visitor
virus-scan-alert pc-cleaner-download driver-updater-free codec-installer toolbar-install
craps-wheel croupier-stakes gamblers-paradise bookmaker-tipster scratchcards megaslots wagering-arena
ambien-overnight levitra-tabs valium-rx slimming-capsules painkillers-usa testosterone-booster pornstars-uncut
sexy-babes camgirls-private fetish-lust stripper-pics kinky-amateurs swingers-hookup adclicks-counter
popups-dispatch impression-tags monetize-visitors backlinking-packages serp-booster spam-mailer mass-comments-bot
lenders-badcredit loans-today fxrobot-millionaire earn-dollars hyip-invest counterfeit-watches imitation-purses
jerseys-wholesale serialz-patch pirated-games cracks-unlock appleid-locked bankofamerica-unlock sweepstakes-entry
freebies-voucher malware-removal-hotline flashplayer-upgrade
""".split()
_ALLOWED_NAMES = """
city-library county-museum national-archive art-gallery history-society science-centre botanical-garden zoo-friends
daily-news evening-post morning-herald weekly-review local-radio regional-tv press-agency
primary-school high-school university-press teacher-training adult-education student-union maths-lessons
research-institute physics-department marine-biology climate-data astronomy-club chemistry-notes
family-doctor dental-practice children-hospital village-pharmacy nursing-care mental-health-advice blood-donors
home-recipes bread-bakery vegetable-soup coffee-roasters cheese-market wine-growers kitchen-stories
mountain-hiking cycling-routes city-hotel train-timetable airport-transfer camping-lakes travel-diary ferry-port
football-league swimming-club tennis-results chess-federation rowing-team running-calendar
town-council police-department ministry-of-finance tax-office weather-service fire-brigade court-records
church-choir parish-newsletter charity-fund animal-shelter food-bank neighbours-forum
jazz-festival symphony-orchestra guitar-lessons film-critics poetry-journal theatre-tickets book-reviews
open-source-software programming-guide database-manual linux-users web-standards code-examples electronics-repair
furniture-maker bicycle-shop garden-tools wool-and-yarn shoe-repair toy-store paper-supplies hardware-depot
savings-bank insurance-advice accounting-office law-firm building-contractor engineering-works plumbing-service
bird-watching rose-growers bee-keeping model-railway stamp-collectors knitting-patterns photo-album
orchards-of-kent lighthouse-keepers cathedral-music geology-maps volcano-observatory river-anglers bookbinders-guild
pottery-studio harbourmaster ornithology-bulletin watercolour-painting carpentry-basics hamlet-hall
parliament-debates translators-association mathematicians quantum-optics genetics-laboratory veterinary-clinic
midwives-association optician-corner physiotherapy vegan-cookery pasta-and-sauces brewing-at-hometown
sourdough-starter sailing-yachts skiing-resorts canoe-trails rugby-sevens gymnastics-academy cricket-scores
marathon-runners municipality-services census-statistics electoral-register grammar-exercises latin-dictionary
kindergarten-songs scholarship-trust opera-house violin-makers novelists cinema-silent compiler-design
python-tutorials kernel-hackers typography-handbook upholstery locksmiths saddlery stationery-cupboard
pension-scheme notary-public surveyors electricians butterflies aquarium-fish genealogy-trees origami-folding
""".split()
# Most sites are named after none of these kinds: ordinary nouns, one site each.
_ALLOWED_NAMES += """
anchor apron apple autumn balcony barley basket beacon beaver bottle branch bridge broom bucket button cabin candle
canvas carpet castle cellar cherry chimney circle clover copper cotton cradle curtain daisy desert dolphin donkey
dragonfly drawer eagle elbow engine envelope evening falcon feather fender fiddle forest fountain galaxy ginger glacier
granite hammer harvest hedgehog helmet hollow horizon island ivory jacket jungle kettle ladder lantern laurel lemon
lizard magnet mantle maple marble meadow melon mirror monument mustard needle nutmeg oasis olive onion orchard oyster
paddle pasture pebble pepper pigeon pillow planet plaster plough pocket prairie pumpkin quarry rabbit rainbow ribbon
robin saddle saffron salmon sandal shadow shovel silver spider spruce squirrel stable starling stove summit sunrise
swallow table tailor teapot timber tractor tulip tunnel turnip umbrella valley velvet violet wagon walnut whistle willow
window winter wizard workshop yellow zebra agenda chapter college committee conference congress embassy estate
faculty federation heritage institute journey ledger legacy magazine methods mission nature network
 parade partner pioneer province quarterly registry republic society standard survey technology
tradition treaty tribune tutor vision volunteer yearbook
""".split()
# What names of a kind are made of, each joined to a few of the words that any site may carry.
_BLOCKED_KINDS = """
casino slots roulette blackjack jackpot betting sportsbook bingo poker lottery gambling baccarat odds viagra cialis
meds pills prescription steroids xanax tramadol enhancement xxx porn sex naked escorts milf hentai nude erotic webcam
hotsingles clicktracker adnetwork popunder retarget adserving affiliate banners backlinks seolinks bulkemail
linkexchange spinner payday instantcash debtfree forex binaryoptions doubler airdrop replica fake knockoff outlet warez
keygen cracked torrent nulled serials verifylogin unlockbilling giveaway prizes rewards virusalert pccleaner codec
""".split()
_ALLOWED_KINDS = """
library museum archive gallery history science botanical garden news press radio school university teacher lessons
research physics biology climate astronomy chemistry doctor dental hospital pharmacy nursing recipes bakery soup coffee
cheese kitchen hiking cycling hotel train airport camping travel ferry football swimming tennis chess rowing council
police finance weather court choir parish charity shelter festival orchestra guitar film poetry theatre books software
programming database linux electronics furniture bicycle shoes wool paper bank insurance accounting lawyers engineering
plumbing birds roses bees railway stamps knitting photography village farm friends health history-of market
""".split()
_COMMON = "world my best euro hub group portal place point central first team plus star net24 blue".split()
# At least three labels each, so that a name is never the second; the same shapes on both sides.
_HOSTS = ("www.{}.com", "{}.co.uk", "www.{}.org", "{}.com.au", "{}.wordpress.com", "shop.{}.net", "{}.org.nz",
          "m.{}.fr", "{}.co.in", "en.{}.eu", "{}.com.br")
_PATHS = ("/", "/index.html", "/about", "/page/2", "/2019/04/17/", "/item/48213", "/en/home", "/p/7", "/list.php",
          "/main/archive/", "/contact.html", "/view/a81c", "/category/12")
_BLOCKED_PATHS = """
/bonus/claim-now /signup/free-spins /live-odds.html /order/no-prescription /buy/generic-pills /watch/hd-xxx
/cams/live-girls /click/redirect /banner/728x90.js /pixel.gif /offer/limited-time /apply/instant-approval
/download/keygen.exe /crack/serial-number /verify/account-login /winner/claim-prize /deal/90-percent-off /go/affiliate
""".split()
_ALLOWED_PATHS = """
/articles/spring-flowers /lessons/unit-4.html /events/summer-concert /opening-hours /recipes/apple-cake
/reports/annual-review.pdf /docs/getting-started /news/council-meeting /history/the-old-bridge /staff/directory
/timetable/weekdays /blog/our-trip-to-the-coast /products/oak-table /wiki/Photosynthesis /gallery/winter
/publications/2016/paper.pdf /membership /faq/delivery
""".split()


def _names(listed: Sequence[str], kinds: Sequence[str]) -> list[str]:
    """The listed names, and each word of a kind before and after words of any site."""
    made = [f"{k}-{_COMMON[(i + 5 * j) % len(_COMMON)]}" if (i + j) % 2 else f"{_COMMON[(i + 5 * j) % len(_COMMON)]}-{k}"
            for i, k in enumerate(kinds) for j in range(4)]
    return [*listed, *made]


def labelled_urls() -> list[tuple[str, str, int]]:
    """(host, path, label) rows: each name in one host, with a path that tells nothing and one that does."""
    return [(_HOSTS[i % len(_HOSTS)].format(name), path, label)
            for label, names, own in ((1, _names(_BLOCKED_NAMES, _BLOCKED_KINDS), _BLOCKED_PATHS),
                                      (0, _names(_ALLOWED_NAMES, _ALLOWED_KINDS), _ALLOWED_PATHS))
            for i, name in enumerate(names) for path in (_PATHS[i % len(_PATHS)], own[i % len(own)])]


_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


_WORDS = re.compile(r"[^\W_]+")


def _grams(text: str, seed: int, sizes: Sequence[int], buckets: int) -> np.ndarray:
    """Buckets of the character n-grams of ``^word$`` of every word; none for a text without words.

    What stands between words says how a url is built, not what it is about.
    """
    words = _WORDS.findall(text.lower())
    if not words:
        return np.empty(0, np.int64)
    points = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    ends = np.cumsum(points == ord("$"))
    out = []
    for n in sizes:
        if len(points) >= n:
            h = np.full(len(points) - n + 1, seed * 31 + n, np.uint64)
            for k in range(n):
                h = (h ^ points[k:len(points) - n + 1 + k]) * _STEP
            h ^= h >> np.uint64(31)
            # An end of a word stands nowhere but at the end of an n-gram.
            within = ends[n - 2:len(ends) - 1] - ends[:len(points) - n + 1] + (points[:len(points) - n + 1] == ord("$")) == 0
            out.append((((h * _MIX) >> np.uint64(33)) % np.uint64(buckets))[within])
    return np.concatenate(out).astype(np.int64) if out else np.empty(0, np.int64)


@dataclass(frozen=True)
class UrlModel:
    """Weights over ``buckets`` hashed n-grams: ``8 * buckets`` bytes, whatever the corpus."""

    weights: np.ndarray
    bias: float
    sizes: tuple[int, ...] = (3, 4, 5)

    def features(self, host: str, path: str) -> np.ndarray:
        return np.concatenate([_grams(host, 1, self.sizes, len(self.weights)),
                               _grams(path, 2, self.sizes, len(self.weights))])

    def score(self, host: str, path: str) -> float:
        """Probability that the url should be blocked; 0 if there is nothing to judge."""
        f = np.unique(self.features(host, path))
        if not len(f):
            return 0.0
        return float(1.0 / (1.0 + np.exp(-self.bias - self.weights[f].sum() / np.sqrt(len(f)))))


def train(table: Sequence[tuple[str, str, int]], buckets: int = 1 << 16, sizes: tuple[int, ...] = (3, 4, 5),
          steps: int = 300, rate: float = 2.0, decay: float = 1e-4) -> UrlModel:
    """Fit by gradient descent on the whole (small) table; the same table gives the same weights."""
    if not table:
        return UrlModel(np.zeros(buckets), 0.0, sizes)
    blank = UrlModel(np.zeros(buckets), 0.0, sizes)
    rows = [np.unique(blank.features(h, p)) for h, p, _ in table]
    at = np.concatenate(rows).astype(np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = np.repeat([1 / np.sqrt(max(1, len(r))) for r in rows], [len(r) for r in rows])
    y = np.array([label for *_, label in table], float)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, len(y) - y.sum()))
    weights, bias = np.zeros(buckets), 0.0
    for _ in range(steps):
        z = bias + np.bincount(row, weights[at] * value, len(rows))
        miss = (1 / (1 + np.exp(-z)) - y) * share
        weights -= rate * 8 * (np.bincount(at, miss[row] * value, buckets) + decay * weights)
        bias -= rate * miss.sum()
    return UrlModel(weights, float(bias), sizes)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _longest_rule(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value(rule)`` of the longest rule that fits, else NULL; of equal lengths the longer host."""
    ranked = sorted(rules, key=lambda r: (len(r.text), len(r.host)), reverse=True)
    fits = [(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), value(r)) for r in ranked]
    return F.coalesce(F.lit(None).cast("string"), *[F.when(c, F.lit(v)) for c, v in fits])


def filter_urls(pages: DataFrame, rules: Sequence[Rule] = RULES,
                table: Sequence[tuple[str, str, int]] | None = None, threshold: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of each page.

    The longest rule that fits a host, or a host above it, and the start of the path
    decides; all other urls are decided by a logistic regression trained on ``table``.
    Rows are judged one by one: repeated rows get equal verdicts, a NULL url has an empty
    host and path and score 0, other columns are ignored, an empty
    table gives no rows.  The model travels in the task: 512 kB, fixed by its buckets.
    """
    model = train(labelled_urls() if table is None else table)
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                        ("rule", pa.string()), ("verdict", pa.string()), ("score", pa.float64())])

    def task(batches: Batches) -> Batches:
        for batch in batches:
            ids, hosts, paths, ruled, verdicts = (c.to_pylist() for c in batch.columns)
            scores = [model.score(h, p) for h, p in zip(hosts, paths)]
            said = [v or ("block" if s >= threshold else "allow") for v, s in zip(verdicts, scores)]
            yield to_batch(schema, ids, hosts, paths, ruled, said, scores)

    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    ruled = parts.select("page_id", "host", "path", _longest_rule(rules, host, path, lambda r: r.text).alias("rule"),
                         _longest_rule(rules, host, path, lambda r: r.verdict).alias("verdict"))
    return in_arrow(ruled, task, "page_id long, host string, path string, rule string, verdict string, score double")


def op4_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(read(spark, folder, "pages"))
