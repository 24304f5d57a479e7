"""The url model on a list of its own: no word of a host or path in common with the labelled table.

The list is the second of its kind: the first one's words went into the table.  Words that also stood in
the table were replaced, on either side, before the figures were taken, which were taken once.
"""

import re

import pyarrow.parquet as pq

from vacancylens.llm import url_filter

BLOCKED = """
www.pokies.com/lobby punters-bets.net/accumulator keno-draws.org/ sportsbetting-wagers.co.uk/
casinos-royal.biz/welcome rummy-tournaments.net/chips slotspins.ru/machine bettors-lounge.org/picks
sildenafil-generics.com/ tadalafil-pharma.net/dosage oxycodone-orders.biz/ phentermine.co/tablets
hydrocodone.org/stock anabolic-roids.biz/cycles viagras.net/price botox-injections.com/specials sexcams.com/models
porno.net/latest nudes-leaked.org/ hookups.net/meet escorting.tv/rates erotica-chats.xxx/rooms
pornographic-clips.com/new webcams.net/show adserver-rotator.com/ popads-zone.net/tag clicktracking.io/b.gif
trackers-pixels.net/collect affiliates-payouts.com/join bannerads-swap.org/ backlinker-pro.net/
seoranking-tricks.com/ bulkmailer-send.net/lists spamblaster.org/run paydayloans.com/lend creditscore-fixers.net/
forexsignals.biz/ bitcoins-doubling.net/ replicas.cn/catalogue fakes-handbag.com/leather warezsite-files.to/all
torrents-hub.net/seed keygens-cracker.net/patches accountverify-alerts.com/ prizewinner-claims.net/collect-now
antivirus-popup.com/fix
""".split()
ALLOWED = """
www.apiarists.co.uk/hives windmill-preservation.org/sails cloister-gardens.eu/herbs glaciologists.edu/cores
tide-tables.gov/ports trout-streams.net/hatches papermaking.org/pulp ceramics.com/glazes lifeboat-crews.org/rescues
raptor-sightings.net/kites woodcarvers.org/chisels parishioners.org/hymnal interpreters.eu/glossary
algebraists.edu/rings neuroscientists.ac.uk/synapses paediatric-nurses.org/wards audiologists.co.uk/hearing
pilates-classes.net/mats gluten-dough.com/crusts risotto-kitchens.it/rice cider-presses.org/apples-varieties
dinghy-sailors.com/moorings alpine-huts.at/ kayakers.ca/rapids netball-leagues.org/umpires orienteering.net/controls
decathletes.org/javelin bin-collections.gov/weeks archivists.gov/parchment ballots.org/polling
spelling-bee.com/vowels sanskrit-readers.net/verses nursery-rhymes.org/tunes bursary.org/applicants
ballet-company.at/premieres luthiers.it/fretboards playwrights.org/ documentary.fr/reels parsers.org/tokens
javascript.net/closures firmware-builders.org/bootloader letterpress.com/inks weavers-loom.co.uk/warp
cobblers.com/soles harness.ie/bridles pens.com/nibs annuities.co.uk/retirement conveyancers.org/titles
land.com/parcels roofers.net/slates moths-count.org/larvae koi-ponds.com/filters ancestors.net/baptisms
jigsaw.jp/pieces lichen.org/spores granary.eu/mill tramways.org/depots meteorologists.edu/isobars
""".split()


def _words(urls):
    return {w for u in urls for w in re.split(r"[^a-z]+", u.lower()) if len(w) > 3}


def _names(host):
    return {w for w in host.lower().split(".") if "-" in w}


def test_the_list_shares_no_word_with_the_table():
    """Neither in hosts nor in paths."""
    table = _words(h + p for h, p, _ in url_filter.labelled_urls())
    shared = table & _words(BLOCKED + ALLOWED)
    assert not shared, shared


def test_no_name_of_the_test_tables_stands_in_the_table():
    urls = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["url"])["url"].to_pylist()
    tested = set().union(*(_names(re.sub(r"^.*?://([^/?#]*).*", r"\1", u)) for u in urls if u))
    assert tested and not tested & set().union(*(_names(h) for h, _, _ in url_filter.labelled_urls()))


def test_accuracy_on_the_list(record_property):
    model = url_filter.train(url_filter.labelled_urls())

    def share(urls):
        parts = [u.partition("/") for u in urls]
        return sum(model.score(h, "/" + p) >= 0.5 for h, _, p in parts) / len(urls)
    caught, wrongly = share(BLOCKED), share(ALLOWED)
    record_property("caught", caught)
    record_property("wrongly", wrongly)
    print(f"blocked {caught:.3f} of {len(BLOCKED)}, wrongly {wrongly:.3f} of {len(ALLOWED)}")
    assert caught >= 0.8 and wrongly <= 0.3
