from churnspark.plans.preprocess import discount_prices, merge_inputs

DATES = ["date_activ", "date_end", "date_modif_prod", "date_renewal"]


def test_client_price_merge_fixture(spark):
    clients = spark.createDataFrame([
        ("a", "2015-01-05", "05-01-2016", "01/05/2015", "5 Jan 2016", "MISSING", 10.0),
        ("b", "January 5, 2015", "2016-01-05", "2015-06-01", "2016-01-05", "x", 20.0),
        ("c", "2015-02-30", "2016-01-05", "2015-06-01", "2016-01-05", "x", 30.0),   # invalid date -> dropped
        ("d", "2015-01-05", "2016-01-05", "2015-06-01", "2016-01-05", "y", 40.0),   # no prices -> dropped
    ], "id string, date_activ string, date_end string, date_modif_prod string, date_renewal string, "
       "channel_sales string, cons double")
    prices = spark.createDataFrame([
        ("a", "2015-01-01", 1, 1.0), ("a", "2015-02-01", 2, 2.0), ("a", "2015-02-01", 3, 4.0),   # tied dates
        ("b", "2015-03-01", 4, 5.0), ("b", "2015-01-01", 5, 5.0),                               # constant, out of order
        ("b", "2015-02-01", 6, None),                                                           # NULL price row dropped
        ("z", "2015-01-01", 7, 9.0),                                                            # unknown id
    ], "id string, price_date string, seq long, p double")
    m = {r["id"]: r for r in merge_inputs(clients, prices, "id", DATES, ["p"], tiebreak=["seq"]).collect()}
    assert set(m) == {"a", "b"}
    a, b = m["a"], m["b"]
    assert a["contract_length"] == 365 and a["days_until_end"] == 1457
    assert a["last_p"] == 2.0 and a["difference_p"] == 1.0 and abs(a["mean_p"] - 7 / 3) < 1e-12
    assert b["std_p"] == 0.0 and b["p_slope"] == 0.0 and b["last_p"] == 5.0
    d = {r["id"]: r for r in merge_inputs(clients, discount_prices(prices, ["p"], 0.15), "id", DATES, ["p"],
                                          tiebreak=["seq"]).collect()}
    assert abs(d["a"]["mean_p"] - 0.85 * 7 / 3) < 1e-12
