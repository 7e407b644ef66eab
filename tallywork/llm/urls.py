"""URL filter: host and path rules, then logistic regression on hashed character n-grams.

The model is trained on a small labelled table of whole URLs (`labelled`, or the
caller's). Host and path give separate n-grams. Rules are a short list of the
operator's settings, tested in one expression, the longest first.

A null url, or one without `://`, has an empty host and path, fits no rule, and
is judged by the model without any n-gram, that is by its intercept. Repeated
rows are judged one by one.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywork.llm.wording import ascii_lower

SIZES = (3, 4, 5)
FEATURES = 1 << 16


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


# The rules of the registered query.
RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]

#: Hand-labelled sites and paths. Whole URLs are made of them by `whole_urls`.
GOOD_SITES = """
city-library museum-of-rivers oakfield-garden northcoast-weather physics-department morning-herald kitchenbook lakeside
hillview-school astronomy-club woodcraft opendata cycling-routes local-history daily-gazette linguistics bergwandern
cuisine-familiale noticias-locales football-league chess-school birdwatching harbour-news government-forms train-times
bakery symphony-orchestra photography parenting chemistry survey-maps bookreview poems compiler farming-weekly biology
carpentry art-gallery village-players marathon climate-research volunteers geology travel-notes knitting sailing-club
mathematics teachers-room dictionary elections piano-lessons medicine-journal robotics camping public-radio grammar
aquarium solar-energy beekeeping observatory teahouse railways hiking cheese-and-wine adventure addresses billing-help
trackside-photos freeland spinach winery betty-bakes market-hall island-ferries winter-sports freshwater castle-tours
lemon-grove pottery bluebird-cafe family-dentist plumbing jazz-club vegetable-box kayak-rental opticians meadow-view
daycare ceramics skating violin-makers bicycle-repair quilting city-council pharmacy-school map-archive geography
kindergarten landscape quarry canal-boats fire-brigade lighthouse tennis-club embroidery pumpkin-patch mushroom-guide
vineyard coffee-roasters folk-music botanic comic-books plum-orchard swimming-pool parliament housing-advice campus-life
radio-amateurs economics-review dance-studio upholstery watercolour old-mill bus-timetable language-help weavers
""".split()
BAD_SITES = """
royal-casino casino777 online-casino-bonus playcasino vip-casinos pokerstars-cash slots-jackpot sportsbet-live bets4you
bet-bonus livebets winbet-odds free-spins-now bigwin-lotto winner-prizes viagra-shop pills-online pillstore cheapmeds
discount-pharmacy buy-cialis dietpills cheap-replica cheapwatches cheap-loans payday-cash fast-credit free-iphone
freegift-winner freemoney free-cash get-rich-now xxx-videos porn-tube adultcams hot-adults adult-dating sexchat-live
nude-pics escort-girls x-rated bannerfarm-ads adserver ads-network ad-clicks popup-ads tracker-pixel clicktracking
trackstat user-trackers tracking-cdn spammy-links spamhost mailspam spam-blast linkfarm seo-farm articlefarms
content-farms malware-drop phish-login keygen-crack warez-full torrent-cracks fake-antivirus hacked-accounts
crypto-doubler bitcoin-giveaway binary-options sports-bets pill-deals casino-games mega-casino casino-cash
instant-win win-prizes betsclub all-bets poker-bonus slot-bonus herbal-pills adult-shop sex-shop ads-exchange
free-ringtones free-credits free-slots best-bets horse-bets betsnow cheap-viagra cheap-followers cheap-cigarettes
cheap-essays ads-delivery ads-popunder push-ads mobile-ads track-visitors fast-track-ads email-track casino-live casino-lotto
lotto-win mega-win jackpot-win sleeping-pills weight-loss-pills cheap-tablets cheap-steroids
""".split()
#: Beginnings and endings of hosts: both classes have all of them, so that they tell nothing.
STARTS = ["", "www.", "m.", "blog."]
ENDS = [".com", ".net", ".org", ".info", ".co.uk", ".de", ".fr", ".biz", ".example.com", ".example.net", ".test"]
GOOD_PATHS = """
/ /index.html /en/12 /fr/340 /de/77.html /es/91/ /en/2024/05/garden-in-spring /news/2023/council-meeting.html /about
/about/history /contact /articles/1832 /article.php /library/catalogue/search /courses/algebra/lesson-3
/docs/guide/install.html /wiki/Roman_roads /blog/2022/11/autumn-walk /recipes/bread/rye.html /forum/topic/552
/opening-hours /exhibitions/2021/maps /research/papers/41.pdf /weather/forecast/monday /sport/results/round-9
/fr/actualites/2020/musee /de/wanderwege/alpen /es/recetas/sopa /events/concert-series /teachers/worksheets/7
/health/vaccination.html /travel/italy/rome /books/review/3310 /science/planets/saturn /products/chairs/oak.html
/en/page/5 /faq /team/staff.html /en/881 /de/204 /fr/5/ /es/63.html /en/1 /fr/17.html
""".split()
BAD_PATHS = """
/casino/bonus /poker/bonus-code /fr/poker-gratuit /en/bet-bonus /online-casino/free-spins.html /en/casino/slots /play/poker/jackpot /de/casino/freispiele /bets/today
/sports-betting/odds /fr/paris-sportifs/bonus-gratuit /win-cash-now /you-are-a-winner /claim/free-gift.html
/free-money/signup /buy-viagra.html /shop/pills/order-now /en/cheap-pills-no-prescription /pharmacy/cialis-online
/replica-watches/cheap /payday-loans/apply /es/prestamos-rapidos/cash /xxx/videos/12 /porn/free/teen.html
/adult/gallery/77 /en/adult-video/34 /sex-chat/live /nude/cams /ads/banner.php /ads/popup/5 /adclick/redirect
/track/pixel.gif /tracking/click/991 /click.php /popunder.js /spam/list.html /links/farm/88 /seo/backlinks-cheap
/crack/keygen.exe /warez/full-download /torrent/cracked.html /login/verify-account-paypal /crypto/double-your-bitcoin
""".split()


def whole_urls() -> list[tuple[str, float]]:
    """The labelled URLs. Sites of both classes have all harmless paths in the same places; a bad path is blocked on any site."""
    places = [(STARTS[n % len(STARTS)], ENDS[n % len(ENDS)], path) for n, path in enumerate(GOOD_PATHS)]
    found = [(f"http://{start}{site}{end}{path}", label) for label, sites in ((0.0, GOOD_SITES), (1.0, BAD_SITES))
             for site in sites for start, end, path in places]
    for n, site in enumerate(8 * (GOOD_SITES + BAD_SITES)):
        found.append((f"http://{STARTS[n % len(STARTS)]}{site}{ENDS[n % len(ENDS)]}{BAD_PATHS[n % len(BAD_PATHS)]}", 1.0))
    return found


def labelled(spark: SparkSession) -> DataFrame:
    """The labelled URL table: `url`, and `label` 1.0 for those to block."""
    def rows(label: float) -> DataFrame:
        urls = "\n".join(url for url, given in whole_urls() if given == label)
        return spark.range(1, numPartitions=1).select(F.explode(F.split(F.lit(urls), "\n")).alias("url"), F.lit(label).alias("label"))

    return rows(0.0).union(rows(1.0))


def host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _ngrams(text: Column, mark: str) -> Column:
    """Character n-grams of the text between two end marks."""
    full = F.concat(F.lit("^"), text, F.lit("$"))
    lists = [
        F.when(
            F.char_length(full) >= size,
            F.transform(
                F.sequence(F.lit(1), F.char_length(full) - size + 1),
                lambda at, size=size: F.concat(F.lit(mark), F.substring(full, at, F.lit(size))),
            ),
        ).otherwise(F.array().cast("array<string>"))
        for size in SIZES
    ]
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.concat(*lists))


def parts(urls: DataFrame, url: str = "url") -> DataFrame:
    """Add `host`, `path` and their n-grams."""
    return urls.select("*", host(F.col(url)).alias("host"), path(F.col(url)).alias("path")).withColumn(
        "_grams", F.concat(_ngrams(F.col("host"), "h"), _ngrams(F.regexp_replace("path", r"\d+", "0"), "p"))
    )


def train(table: DataFrame, features: int = FEATURES) -> PipelineModel:
    """Fit on a labelled table (`url`, `label`); its size is the caller's bound."""
    return Pipeline(stages=[
        HashingTF(inputCol="_grams", outputCol="_features", numFeatures=features, binary=True),
        LogisticRegression(featuresCol="_features", labelCol="label", predictionCol="_block",
                           probabilityCol="_odds", rawPredictionCol="_raw", regParam=0.01, maxIter=60),
    ]).fit(parts(table.filter("url IS NOT NULL AND label IS NOT NULL")))


def first_rule(rules: list[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct of its name and verdict; null if none does."""
    order = sorted(rules, key=lambda rule: (-len(rule.host + rule.path), -len(rule.host), rule))
    found = [
        F.when(
            ((F.col("host") == rule.host) | F.col("host").endswith(f".{rule.host}"))
            & F.col("path").startswith(rule.path),
            F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")),
        )
        for rule in order
    ]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge(pages: DataFrame, model: PipelineModel, rules: list[Rule] = RULES, url: str = "url") -> DataFrame:
    """Add `host`, `path`, `rule` and `verdict`; columns of the input with these names are replaced."""
    own = F.struct(*[name for name in pages.columns if name not in ("host", "path", "rule", "verdict")])
    scored = model.transform(parts(pages.select(own.alias("_row"), F.col(url).alias("url"))))
    method = F.when(F.col("_block") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("_rule", first_rule(rules)).select(
        "_row.*", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), method).alias("verdict"),
    )
