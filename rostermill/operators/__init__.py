"""DataFrame → DataFrame operators. Lazy: none of them runs a job."""
