"""Spark ML jobs: factor tables, trees and leaves, classifiers, batch scoring."""
