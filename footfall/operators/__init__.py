"""DataFrame -> DataFrame steps. None of them collects, caches or broadcasts."""
