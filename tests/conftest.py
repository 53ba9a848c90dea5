import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from termlens.session import build_session
    s = build_session("local[4]", shuffle_partitions=4, app="termlens-tests")
    yield s
    s.stop()


# --- fixed values: worked sample 1 (closing quote restored as two single quotes), whose
# keywords, offsets and contexts an extraction must reproduce ---------------------------
SAMPLE1_TEXT = (
    "Pitcher Steve Barber joined the club one week ago after completing his hitch under the Army's accelerated "
    "wintertime military course , also at Fort Knox , Ky. .The 22-year-old southpaw enlisted earlier last fall "
    "than did Hansen .Baltimore's bulky spring-training contingent now gradually will be reduced as Manager Paul "
    "Richards and his coaches seek to trim it down to a more streamlined and workable unit . \" Take a ride on "
    "this one '' , Brooks Robinson greeted Hansen as the Bird third sacker grabbed a bat , headed for the plate "
    "and bounced a third-inning two-run double off the left-centerfield wall tonight .It was the first of two "
    "doubles by Robinson , who was in a mood to celebrate ."
)
SAMPLE1_KEYWORDS = ['Pitcher', 'completing', 'wintertime', 'southpaw', 'gradually', 'trim', 'greeted', 'Bird',
                    'sacker', 'grabbed', 'bat', 'double', 'wall', 'tonight', 'celebrate']
SAMPLE1_OFFSETS = [[(0, 7)], [(56, 66)], [(106, 116)], [(176, 184)], [(278, 287)], [(353, 357)], [(455, 462)],
                   [(477, 481)], [(488, 494)], [(495, 502)], [(505, 508)], [(567, 573)], [(599, 603)],
                   [(604, 611)], [(680, 689)]]
SAMPLE1_CONTEXTS = [
    "Pitcher Steve Barber joined the club one week ago after completing his hitch under the Army's accelerated",
    "accelerated wintertime military course , also at Fort Knox , Ky. .The 22-year-old southpaw enlisted earlier",
    "contingent now gradually will be reduced as Manager Paul Richards and his coaches seek to trim it down to",
    "one '' , Brooks Robinson greeted Hansen as the Bird third sacker grabbed a bat , headed for the plate",
    "bounced a third-inning two-run double off the left-centerfield wall tonight .It was the first of two doubles",
    " .It was the first of two doubles by Robinson , who was in a mood to celebrate .",
]
