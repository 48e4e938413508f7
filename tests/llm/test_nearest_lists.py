"""Every vector finds its nearest list, however far apart the clusters are."""

import numpy as np
import pandas as pd
from mnemolake.llm import neighbours as N


def test_nearest_list_of_clustered_vectors():
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(300, 32))
    x = N._unit(centres[rng.integers(0, 300, 6000)] + 0.2 * rng.normal(size=(6000, 32)))
    sample = pd.DataFrame({"profile_key": "p", "n": len(x), "g": np.arange(len(x)), "q": list(np.round(x * N.STEP).astype(np.int16))})
    graph = N.CentroidGraph.of(N._fitter(4, 65_536)(sample))
    ids, sims = graph.search(x, beam=8)
    exact = x @ graph.c.T
    assert len(graph.c) > 1000
    assert np.allclose(sims[:, 0], exact.max(axis=1), atol=1e-5)
    assert np.allclose(np.sort(sims[:, :3], axis=1), np.sort(exact, axis=1)[:, -3:], atol=1e-5)
