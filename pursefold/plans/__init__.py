"""What users ask for: profiles, payments, activity, apps, sources, promotions, the daily run."""
