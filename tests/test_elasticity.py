"""Grouped elasticity against numpy, for every brand."""

import numpy as np
import pytest

from tessera.plans import retail as R
from tessera.plans.fixtures import fixture

from .conftest import SF_MID


def test_every_brand_has_its_own_regression(spark):
    monthly = fixture(spark, SF_MID, "v_brand_month")
    panel = R.add_model_terms(R.rival_panel(monthly), ["own", "r2", "r3"]).toPandas()
    brands = sorted(panel["brand"].unique())
    assert len(brands) == monthly.select("brand").distinct().count() > 3
    got = R.elasticity_by_brand(monthly).toPandas()
    assert sorted(got["brand"].unique()) == brands
    for brand in brands[:3] + brands[-2:]:
        own = panel[panel["brand"] == brand]
        following = brands[(brands.index(brand) + 1) % len(brands)]
        months = panel[panel["brand"] == following].set_index(["y", "m"])["price_own"]
        for r in own.itertuples():
            if (r.y, r.m) in months.index:
                assert r.price_r2 == months[r.y, r.m]
        for model, terms in (("m2", ["ln_p_own"]), ("m3", ["ln_p_own", "prom_own_maj", "prom_own_min"])):
            have = own[["ln_q_own", *terms]].dropna().to_numpy(float)
            x = np.column_stack([np.ones(len(have)), have[:, 1:]])
            want = np.linalg.lstsq(x, have[:, 0], rcond=None)[0]
            fit = got[(got["brand"] == brand) & (got["model"] == model)].set_index("term")["estimate"]
            assert fit[["(Intercept)", *terms]].tolist() == pytest.approx(want.tolist(), rel=1e-6, abs=1e-8)
