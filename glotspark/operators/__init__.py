"""DataFrame operators: cleaning, grams, profiles, features, models, evaluation."""
