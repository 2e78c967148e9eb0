"""Plan-level helpers: size checks, lookups that survive hot keys, and the end-to-end jobs."""
