import datetime as dt

from mobility.operators import payment_by_length, payment_evolution, rate_code_distribution, rate_code_evolution
from tests.conftest import make_trips, trip


def _trips(spark):
    return make_trips(
        spark,
        [trip(0, rate=1, pay=1), trip(0, rate=1, pay=2), trip(0, rate=2, pay=1, dist=35.0), trip(86400, rate=1, pay=1)],
    )


def test_rate_code_distribution(spark):
    out = rate_code_distribution(_trips(spark))
    assert out.columns == ["RateCodeID", "totalTrips"]
    assert [tuple(r) for r in out.collect()] == [(1, 3), (2, 1)]


def test_rate_code_evolution(spark):
    out = rate_code_evolution(_trips(spark))
    assert [tuple(r) for r in out.collect()] == [
        (dt.date(2018, 1, 25), 1, 2),
        (dt.date(2018, 1, 25), 2, 1),
        (dt.date(2018, 1, 26), 1, 1),
    ]


def test_payment_by_length(spark):
    got = {(r.payment_type, r.isLong): r.totalTrips for r in payment_by_length(_trips(spark)).collect()}
    assert got == {(1, False): 2, (2, False): 1, (1, True): 1}


def test_payment_evolution(spark):
    got = [tuple(r) for r in payment_evolution(_trips(spark)).collect()]
    assert got == [(dt.date(2018, 1, 25), 1, 2), (dt.date(2018, 1, 25), 2, 1), (dt.date(2018, 1, 26), 1, 1)]
