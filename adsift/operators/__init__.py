"""DataFrame operators of the ad-log jobs (funnel, enrichment, cohorts, landing pages)."""
