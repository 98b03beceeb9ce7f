"""Text moderation on Spark: rules, classifiers, reviews and live chat."""
