"""Plans made of several Spark jobs: pinned intermediates, keyed fetches, the validation suite."""
